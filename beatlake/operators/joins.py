"""Left joins that survive hot and missing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = 1024
_SHARD = "_shard"


def left_join_sharded(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[Column]) -> DataFrame:
    """Left outer join on equally named ``keys`` with ``right`` unique or small per key.

    A shard number joins the keys. For a row whose keys are all set it is a function of the
    keys, so nothing changes about the matches; a row with a NULL key never matches and gets
    its number from ``spread`` instead, which scatters such rows over the tasks. As neither
    input is partitioned by keys and shard, both sides are shuffled for this join and
    adaptive execution may split a hot key's tasks or broadcast a small right side.
    """
    of_keys = F.pmod(F.xxhash64(*keys), F.lit(SHARDS))
    of_row = F.pmod(F.xxhash64(*spread), F.lit(SHARDS))
    any_missing = F.lit(False)
    for key in keys:
        any_missing = any_missing | F.col(key).isNull()
    left = left.withColumn(_SHARD, F.when(any_missing, of_row).otherwise(of_keys))
    right = right.withColumn(_SHARD, of_keys)
    return left.join(right, [*keys, _SHARD], "left").drop(_SHARD)


def inner_join_sharded(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` that are never NULL, with ``right`` unique or small per key.

    As in ``left_join_sharded`` both sides are shuffled for this join, so that a hot key's tasks can be split. Both
    get the same filters, so that sides made from one frame keep what they share up to its last shuffle.
    """
    shard = F.pmod(F.xxhash64(*keys), F.lit(SHARDS))
    return left.withColumn(_SHARD, shard).join(right.withColumn(_SHARD, shard), [*keys, _SHARD]).drop(_SHARD)


def one_key_per_user(users: DataFrame) -> DataFrame:
    """The dimension with one row per user id: the smallest key where an id repeats."""
    return users.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.min("user_key").alias("user_key"))


def with_user_key(rows: DataFrame, user_column: str, users: DataFrame, spread: Sequence[str]) -> DataFrame:
    """``rows`` with the dimension's ``user_key``, NULL where nobody matches.

    An id that repeats in ``users`` repeats the row; pass ``one_key_per_user`` to prevent it.
    """
    dimension = users.select(F.col("user_id").alias("_user"), "user_key")
    joined = left_join_sharded(
        rows.withColumn("_user", F.col(user_column)),
        dimension,
        ["_user"],
        [F.col(name) for name in spread],
    )
    return joined.drop("_user")
