"""Deduplication, unions, joins and merges on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from beatlake.operators.combine import union_present
from beatlake.operators.dedup import keep_first, keep_least
from beatlake.operators.joins import left_join_sharded, one_key_per_user, with_user_key
from beatlake.operators.merge import BucketedTarget, ParquetTarget, absent, first_per_key, merge


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def at(hour):
    return dt.datetime(2024, 1, 1, hour)


def test_keep_first_takes_the_earliest_and_puts_nulls_last(spark):
    rows = spark.createDataFrame(
        [("a", None, "x"), ("a", at(2), "y"), ("a", at(2), "b"), (None, at(1), "n"), (None, at(0), "m")],
        "id string, time timestamp, text string",
    )
    assert rows_of(keep_first(rows, ["id"], ["time"])) == [("a", at(2), "b"), (None, at(0), "m")]


def test_keep_first_drops_repeats_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS key", "id AS time")
    plan = plan_of(keep_first(rows, ["key"], ["time"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_keep_least_carries_nothing_that_nobody_reads(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS key", "id AS time", "repeat(CAST(id AS STRING), 50) AS text")
    kept = keep_least(rows, ["key"], ["time"])
    assert [(key, time) for key, time, _ in rows_of(kept)] == [(0, 0), (1, 1), (2, 2)]
    assert rows_of(kept) == rows_of(keep_first(rows, ["key"], ["time"]))
    assert kept.columns == rows.columns
    plan = plan_of(kept.groupBy().count()).split("== Physical Plan ==")[1]
    assert "repeat(" not in plan and "Sort" not in plan


def test_union_skips_absent_frames_and_widens_to_text(spark):
    numbers = spark.createDataFrame([(1, 10)], "id int, position bigint")
    texts = spark.createDataFrame([("end", 2)], "position string, id int")
    assert rows_of(union_present([None, numbers, texts])) == [(1, "10"), (2, "end")]
    assert union_present([None]) is None


def test_user_join_keeps_everyone(spark):
    visits = spark.createDataFrame([(1, "u1"), (2, None), (3, "u9"), (4, "u2")], "id int, user string")
    users = spark.createDataFrame([(10, "u1"), (20, "u2"), (15, "u2"), (30, None)], "user_key int, user_id string")
    fanned = with_user_key(visits, "user", users, ["id"]).select("id", "user_key")
    assert rows_of(fanned) == [(1, 10), (2, None), (3, None), (4, 15), (4, 20)]
    single = with_user_key(visits, "user", one_key_per_user(users), ["id"]).select("id", "user_key")
    assert rows_of(single) == [(1, 10), (2, None), (3, None), (4, 15)]


def test_hot_join_keys_are_split_and_missing_ones_spread(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = spark.range(0, 60000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('u', id) END AS user",
        "id",
        "repeat(cast(id AS string), 5) AS payload",
    )
    users = spark.range(0, 60000, 1, 8).selectExpr("id AS user_key", "if(id = 5, 'hot', concat('u', id)) AS user_id")
    joined = with_user_key(rows, "user", one_key_per_user(users), ["id"])
    assert joined.where("user_key IS NOT NULL").count() == 20000 + 20000 - 1
    joined.write.format("noop").mode("overwrite").save()
    left = rows.withColumn("_user", F.col("user")).withColumnRenamed("id", "row")
    right = one_key_per_user(users).withColumnRenamed("user_id", "_user")
    frame = left_join_sharded(left, right, ["_user"], [F.col("row")])
    assert frame.count() == 60000
    frame.collect()
    assert "skew=true" in plan_of(frame)
    # NULL keys have as many shuffle targets as there are shards.
    spread = frame.where("user IS NULL").select(F.spark_partition_id().alias("part")).distinct().count()
    assert spread >= 8


def stage(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, time timestamp, text string")


def test_merge_adds_once_and_keeps_the_earliest(spark, tmp_path):
    target = ParquetTarget(spark, str(tmp_path / "t"))
    merge(stage(spark, ("a", at(5), "first run")), target, "id", "time")
    second = stage(spark, ("a", at(1), "too late"), ("b", at(3), "later"), ("b", at(2), "earlier"))
    for _ in range(2):
        merge(second, target, "id", "time")
    assert rows_of(target.read()) == [("a", at(5), "first run"), ("b", at(2), "earlier")]


def test_merge_without_a_key_adds_again_unless_refused(spark, tmp_path):
    rows = stage(spark, (None, at(1), "x"), (None, at(0), "y"), ("a", at(0), "z"))
    kept = ParquetTarget(spark, str(tmp_path / "kept"))
    refused = ParquetTarget(spark, str(tmp_path / "refused"))
    for _ in range(2):
        merge(rows, kept, "id", "time", keep_null_keys=True)
        merge(rows, refused, "id", "time")
    assert rows_of(kept.read()) == [("a", at(0), "z"), (None, at(0), "y"), (None, at(0), "y")]
    assert rows_of(refused.read()) == [("a", at(0), "z")]


def test_merge_with_dupes_keeps_rows_that_share_key_and_time(spark, tmp_path):
    target = ParquetTarget(spark, str(tmp_path / "t"))
    rows = stage(spark, ("a", at(1), "x"), ("a", at(1), "y"), ("a", at(2), "z"))
    merge(rows.where("text = 'z'"), target, "id", "time", with_dupes=True)
    for _ in range(2):
        merge(rows, target, "id", "time", with_dupes=True)
    assert rows_of(target.read()) == [("a", at(1), "x"), ("a", at(1), "y"), ("a", at(2), "z")]


def test_bucketed_target_is_not_shuffled(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
    )
    target = BucketedTarget(spark, "published_rows", "id", 16)
    for hour in (5, 6):
        merge(stage(spark, ("a", at(hour), "x"), (f"b{hour}", at(1), "y")), target, "id", "time")
    assert rows_of(target.read()) == [("a", at(5), "x"), ("b5", at(1), "y"), ("b6", at(1), "y")]
    fresh = target.aligned(stage(spark, ("a", at(1), "x"))).join(target.read().select("id"), "id", "left_anti")
    executed = fresh._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1
    spark.sql("DROP TABLE published_rows")


def test_a_merge_ranks_its_stage_once(spark, tmp_path):
    path = str(tmp_path / "stage")
    stage(spark, ("a", at(1), "x"), ("a", at(2), "y"), ("b", at(1), "z")).write.parquet(path)
    target = ParquetTarget(spark, str(tmp_path / "t"))
    rows = spark.read.parquet(path)
    target.append(rows.where("id = 'b'"))
    new = absent(first_per_key(rows, "id", "time"), target.read(), ["id"], rows)
    assert rows_of(new) == [("a", at(1), "x")]
    optimized = new._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Window [") == 1
