"""Deduplication with a fixed survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank"
_FIRST = "_first"


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the remaining columns, NULLs last.

    NULL keys form one group. The ``= 1`` filter lets Spark keep a single row per key and map
    task before the shuffle, so a key that holds most of the rows does not load one reducer.
    """
    rest = [name for name in rows.columns if name not in keys and name not in order]
    ranking = [F.col(name).asc_nulls_last() for name in [*order, *rest]]
    window = Window.partitionBy(*keys).orderBy(*(ranking or [F.lit(1)]))
    return rows.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_least(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows of ``keep_first``, by an aggregate, which combines before the shuffle too.

    Where nobody reads the survivors' columns, as in a count, Spark leaves them out of scan, shuffle and sort, and
    only the keys are left.
    """
    carried = [*order, *(name for name in rows.columns if name not in keys and name not in order)]
    ranked = F.struct(*(part for name in carried for part in (F.col(name).isNull(), F.col(name).alias(name))))
    first = rows.groupBy(*keys).agg(F.min(ranked).alias(_FIRST))
    return first.select(*(F.col(name) if name in keys else F.col(_FIRST)[name].alias(name) for name in rows.columns))
