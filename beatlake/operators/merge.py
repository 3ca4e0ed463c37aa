"""Insert-if-absent merges of a staged day into a published table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatlake.operators.dedup import keep_first
from beatlake.sources.lake import read_parquet


def first_per_key(stage: DataFrame, key: str, sort_key: str, keep_null_keys: bool = False) -> DataFrame:
    """The earliest staged row of every key; a row without a time comes last.

    Rows without a key are left out: they are never found in a published table, so that every rerun would
    add one. With ``keep_null_keys`` they count as one key.
    """
    if not keep_null_keys:
        stage = stage.where(F.col(key).isNotNull())
    return keep_first(stage, [key], [sort_key])


def absent(stage: DataFrame, published: DataFrame | None, keys: Sequence[str], wider: DataFrame | None = None) -> DataFrame:
    """Staged rows whose keys are not published. A NULL in a key never matches, so such rows stay.

    An anti join could only broadcast its right side, all that was ever published. The published keys are
    cut to the staged ones first: there the staged side is the right one, and while it is small Spark
    broadcasts it and shuffles no history. What is left is no larger than the stage. ``wider`` are rows with at
    least the stage's keys that are cheaper to read, such as those that the stage was deduplicated from.
    """
    if published is None:
        return stage
    staged = (stage if wider is None else wider).select(*keys).distinct()
    there = published.select(*keys).join(staged, list(keys), "left_semi").distinct()
    return stage.join(there, list(keys), "left_anti")


@dataclass(frozen=True)
class ParquetTarget:
    """A published table as a parquet folder; absent until the first append."""

    spark: SparkSession
    path: str

    def read(self) -> DataFrame | None:
        return read_parquet(self.spark, self.path, merge_schema=False)

    def aligned(self, stage: DataFrame) -> DataFrame:
        return stage

    def append(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class BucketedTarget:
    """A published catalog table bucketed by its key.

    The merge reads only the key column of the whole history and, because that is already
    hashed by key, shuffles just the staged rows. ``folder`` is where a new table's files go, by default the
    catalog's warehouse.
    """

    spark: SparkSession
    table: str
    key: str
    buckets: int
    folder: str | None = None

    def read(self) -> DataFrame | None:
        return self.spark.table(self.table) if self.spark.catalog.tableExists(self.table) else None

    def aligned(self, stage: DataFrame) -> DataFrame:
        return stage.repartition(self.buckets, self.key)

    def append(self, rows: DataFrame) -> None:
        writer = rows.write.mode("append").format("parquet").bucketBy(self.buckets, self.key)
        writer = writer.option("path", self.folder) if self.folder else writer
        writer.saveAsTable(self.table)


def merge(stage: DataFrame, target, key: str, sort_key: str, with_dupes: bool = False, keep_null_keys: bool = False) -> None:
    """Add to ``target`` what it lacks of ``stage``; a rerun with the same stage adds nothing more.

    Rows that lack a key or, ``with_dupes``, a key or a time are left out, as no rerun would find them;
    ``keep_null_keys`` adds them every time (see ``first_per_key``).
    """
    if with_dupes:
        keys = [key, sort_key]
        rows = stage if keep_null_keys else stage.na.drop(subset=keys)
    else:
        rows, keys = first_per_key(stage, key, sort_key, keep_null_keys), [key]
    target.append(absent(target.aligned(rows), target.read(), keys, stage))
