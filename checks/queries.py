"""The registered queries: every job, and every operator on its own, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatlake.functions import rules
from beatlake.operators.combine import union_present
from beatlake.operators.dedup import keep_first
from beatlake.operators.joins import with_user_key
from beatlake.operators.merge import BucketedTarget, ParquetTarget, first_per_key, merge
from beatlake.plans.concurrents import bucket_counts
from beatlake.plans.facts import schema_user
from beatlake.plans.model import MOBILE_COLUMN, Feed, Job
from beatlake.plans.registry import GROUPS, JOBS, jobs_named
from beatlake.plans.runs import Run, row_counts
from beatlake.plans.sessions import (
    ALL_PLATFORMS,
    USER,
    combinations,
    platform_user,
    session_rows,
    session_statistics,
)
from beatlake.sources.dates import run_dates
from beatlake.sources.lake import PLATFORM, RUN_DATE, EventLake, Slice, load_users
from beatlake.sources.tables import read_days, write_days, write_snapshot
from checks import adapters, lakes
from checks.lakes import scratch

Query = Callable[[SparkSession, str], DataFrame]

WHOLE_MONTH = "2024-01-01::2024-01-31"
SECOND_HALF = "2024-01-16::2024-01-31"
FIRST_HALF = "2024-01-15::2024-01-01"
LAKE_FEED = JOBS["signup_button_clicked"].parts[0].feed
DENSE_JOBS = ("live_concurrents", "vod_concurrents")
HEARTBEAT_JOBS = (*DENSE_JOBS, "vod_sessions", "vod_deciles", "sandbox_vod_sessions", "livestream_heartbeat")


# Jobs over adapters


def read_adapter(spark: SparkSession, sf_dir: str, job: Job) -> Callable[[Feed], list[Slice]]:
    def read(feed: Feed) -> list[Slice]:
        if job.name == "subscription":
            return [adapters.raw_subscriptions(spark, sf_dir)]
        if job.name in HEARTBEAT_JOBS:
            return [adapters.raw_heartbeats(spark, sf_dir, feed.platforms, dense=job.name in DENSE_JOBS)]
        return [adapters.raw_events(spark, sf_dir, feed.platforms, titles=job.name == "page_event")]

    return read


def run_job(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    job = JOBS[name]
    users = adapters.users(spark, sf_dir) if job.needs_users else None
    return job.build(read_adapter(spark, sf_dir, job), users)


def without(raw: Slice, *names: str) -> Slice:
    return Slice(raw.rows.drop(*names), raw.platforms)


def on(raw: Slice, *platforms: str) -> Slice:
    return Slice(raw.rows.where(F.col(PLATFORM).isin(*platforms)), platforms)


# Column rules, defaults and filters


def default_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = JOBS["search_event"]
    raw = adapters.raw_events(spark, sf_dir, job.parts[0].feed.platforms)
    web, phones = on(raw, "web"), on(raw, "android", "ios")
    return job.build(lambda feed: [without(web, "selected_tab"), without(phones, "user_tier", "user_id")])


def halves(raw: Slice, *missing: str) -> list[Slice]:
    """The rows until the 15th without some columns, and the later ones with all."""
    early = F.dayofmonth("received_at") <= 15
    return [without(Slice(raw.rows.where(early), raw.platforms), *missing), Slice(raw.rows.where(~early), raw.platforms)]


def default_false_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = halves(adapters.raw_events(spark, sf_dir, ("web",)), "has_sso", "has_video")
    return JOBS["hero_event"].build(lambda feed: slices)


def default_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = halves(adapters.raw_events(spark, sf_dir, ("web",)), "platform")
    return JOBS["hero_impression"].build(lambda feed: slices)


def default_mobile_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.raw_events(spark, sf_dir, ("web", "android", "ios"))
    slices = [without(on(raw, "web", "ios"), MOBILE_COLUMN), on(raw, "android")]
    return JOBS["signup_button_clicked"].build(lambda feed: slices)


def default_mobile_flag_tv(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = JOBS["vod_sessions"].feed
    bare = without(adapters.raw_heartbeats(spark, sf_dir, feed.platforms), MOBILE_COLUMN)
    return feed.complete(bare).select("id", "received_at", F.col(PLATFORM).alias("platform"), MOBILE_COLUMN)


def filter_bots(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    return rows.where(rules.is_not_bot(F.col("context_user_agent"))).select("id", "received_at", "context_user_agent")


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_heartbeats(spark, sf_dir, ("web",)).rows
    kept = rows.na.drop(subset=["session_id", "content_id"])
    return kept.select("id", "received_at", "session_id", "content_id")


def coalesce_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_subscriptions(spark, sf_dir).rows
    moment = F.coalesce(
        F.col("original_timestamp").try_cast("timestamp"), F.col("received_at").try_cast("timestamp")
    )
    return rows.select("id", moment.alias("event_timestamp"))


def pick_user_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.raw_events(spark, sf_dir, ALL_PLATFORMS)
    tv = rules.TV_PLATFORMS
    slices = [on(raw, "android", "ios"), without(on(raw, "web"), "user_id"), without(on(raw, *tv), "user_id", "user_uuid")]
    picked = [
        part.rows.select(
            "id", "received_at", schema_user(part).alias("visit_user"), platform_user(part).alias("session_user")
        )
        for part in slices
    ]
    return union_present(picked)


def normalize_break_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    return rows.groupBy(
        F.col("break_type").alias("raw_type"), rules.renamed(F.col("break_type"), rules.BREAK_TYPES).alias("break_type")
    ).agg(F.count("*").alias("events"))


def normalize_target_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    return rows.groupBy(
        F.col("target_type").alias("raw_type"),
        rules.renamed(F.col("target_type"), rules.TARGET_TYPES).alias("target_type"),
    ).agg(F.count("*").alias("events"))


def user_tier_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    resolved = rules.event_tier(F.col("user_tier"), F.col("user_id"))
    return rows.groupBy(
        F.col("user_tier").alias("raw_tier"), F.col("user_id").isNotNull().alias("signed_in"), resolved.alias("user_tier")
    ).agg(F.count("*").alias("events"))


def matched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows.select("id", "received_at", "user_id", "user_tier")
    return with_user_key(rows, "user_id", adapters.users(spark, sf_dir), ["id"])


def join_dim_user_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matched_events(spark, sf_dir).select("id", "received_at", "user_id", "user_key")


def user_tier_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = rules.session_tier(F.col("user_tier"), F.col("user_key"))
    return matched_events(spark, sf_dir).groupBy(
        F.col("user_tier").alias("raw_tier"), F.col("user_key").isNotNull().alias("matched"), resolved.alias("user_tier")
    ).agg(F.count("*").alias("events"))


def decile_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_heartbeats(spark, sf_dir, ("web",)).rows
    weight = rules.decile_weight(rules.decile(F.col("percentage_watched")))
    return rows.groupBy("percentage_watched", weight.alias("decile")).agg(F.count("*").alias("beats"))


def scalar_date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    return rows.select("id", "received_at", *rules.date_parts(F.col("original_timestamp")))


def scalar_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    lengths = {"path": 500, "label": 64, "query_used": 256, "context": 256, "link_to": 512}
    return rows.select("id", "received_at", *(rules.truncated(name, to).alias(name) for name, to in lengths.items()))


def scalar_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_subscriptions(spark, sf_dir).rows
    return rows.select(
        "id",
        rules.whole_number(F.col("amount_cents"), "string").alias("amount_cents"),
        F.col("trial").try_cast("boolean").alias("trial"),
        F.col("stripe_user").try_cast("boolean").alias("stripe_user"),
        F.col("end_timestamp").try_cast("timestamp").alias("end_timestamp"),
        F.col("amount_cents").try_cast("double").alias("amount"),
    )


def ascii_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",), titles=True).rows
    return rows.select("id", "received_at", rules.ascii_text(F.col("title")).alias("title"))


# Aggregates and deduplication


def beats_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = JOBS["vod_sessions"].feed
    raw = adapters.raw_heartbeats(spark, sf_dir, feed.platforms)
    return session_rows(feed, raw, [MOBILE_COLUMN], "position")


def combined_beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = ["content_id", "anonymous_id", USER, "user_tier", MOBILE_COLUMN]
    return combinations(beats_of(spark, sf_dir), described)


def session_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined_beats(spark, sf_dir).select(
        F.col(PLATFORM).alias("platform"), "session_id", "content_id", "anonymous_id", F.col(USER).alias("user_id"),
        "user_tier", MOBILE_COLUMN, F.col("beats").alias("count"),
    )


def session_stats_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = ["content_id", "anonymous_id", USER, "user_tier", MOBILE_COLUMN]
    return session_statistics(combined_beats(spark, sf_dir), described).select(
        F.col(PLATFORM).alias("platform"), "session_id", "beats", "start_timestamp", "end_timestamp", "max_position",
        "content_id", "anonymous_id", F.col(USER).alias("user_id"), "user_tier", MOBILE_COLUMN,
    )


def session_statistic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    stats = session_statistics(combined_beats(spark, sf_dir), ["content_id"])
    return stats.select(F.col(PLATFORM).alias("platform"), "session_id", name)


def decile_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = adapters.raw_heartbeats(spark, sf_dir, ("web",)).rows.na.drop(subset=["session_id"])
    bit = rules.decile_bit(rules.decile(F.col("percentage_watched")))
    grouped = beats.groupBy("session_id").agg(F.bit_or(bit).alias("bits"))
    return grouped.select("session_id", rules.decile_digits(F.col("bits")).alias("decile"))


def minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    beats = adapters.raw_heartbeats(spark, sf_dir, ALL_PLATFORMS).rows
    return bucket_counts(beats).select(F.col(PLATFORM).alias("platform"), "start_timestamp", "beats")


def dedup_message_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ALL_PLATFORMS).rows
    rows = rows.select("id", PLATFORM, "received_at", "anonymous_id", "user_tier", "position")
    return keep_first(rows, ["id", PLATFORM], ["received_at"]).withColumnRenamed(PLATFORM, "platform")


def dedup_subscription(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_subscriptions(spark, sf_dir).rows
    rows = rows.select("subscription_id", "_event", "event_type", "received_at", "id")
    return keep_first(rows, ["subscription_id", "_event", "event_type"], ["received_at"])


def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    return first_per_key(rows.select("anonymous_id", "original_timestamp", "id"), "anonymous_id", "original_timestamp", True)


def union_platforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = adapters.raw_events(spark, sf_dir, ("web", "ios", "android"))
    columns = ["id", "received_at", PLATFORM, "position"]
    web, ios, android = (on(raw, name).rows.select(columns) for name in raw.platforms)
    mixed = [web, None, ios.withColumn("position", F.col("position").cast("string")), android]
    return union_present(mixed).withColumnRenamed(PLATFORM, "platform")


def by_half(raw: Slice) -> DataFrame:
    """The raw rows of a month as two input days, its halves."""
    half = F.when(F.dayofmonth("received_at") <= 15, F.lit("first")).otherwise(F.lit("second"))
    return raw.rows.withColumn(RUN_DATE, half)


def sessions_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of two input days; positions are text on the web and numbers elsewhere."""
    job = JOBS["vod_sessions"]
    raw = adapters.raw_heartbeats(spark, sf_dir, job.feed.platforms)
    raw = Slice(by_half(raw), raw.platforms)
    web, others = on(raw, "web"), on(raw, *(name for name in raw.platforms if name != "web"))
    web = Slice(web.rows.withColumn("position", F.col("position").cast("string")), web.platforms)
    return job.build(lambda feed: [others, web], adapters.users(spark, sf_dir))


def concurrents_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two input days at once, the second with every third beat of the first half too, as late ones."""
    job = JOBS["vod_concurrents"]
    raw = adapters.raw_heartbeats(spark, sf_dir, job.feed.platforms)
    late = F.pmod(F.hash("id"), F.lit(3)) == 0
    rows = by_half(raw).withColumn(RUN_DATE, F.when(late, F.lit("second")).otherwise(F.col(RUN_DATE)))
    return job.build(lambda feed: [Slice(rows, raw.platforms)])


# Lake, tables, merges


_lakes: dict[tuple[str, str], str] = {}


def lake_of(spark: SparkSession, sf_dir: str) -> str:
    """A raw lake of one feed on three platforms, by event day, written once per session.

    On even days the ios files lack the mobile flag, as a release would leave them.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _lakes:
        root = scratch(spark)
        lake = EventLake(spark, root)
        raw = adapters.raw_events(spark, sf_dir, LAKE_FEED.platforms).rows
        needed = ["id", "anonymous_id", "context_page_url", "location", "received_at", MOBILE_COLUMN]
        raw = raw.select(*needed, PLATFORM, *rules.date_parts(F.col("received_at")))
        even = F.dayofmonth("received_at") % 2 == 0
        for platform in LAKE_FEED.platforms:
            rows = raw.where(F.col(PLATFORM) == platform).drop(PLATFORM)
            path = lake.feed_root(LAKE_FEED.segment_type, platform)
            if platform == "ios":
                write_days(rows.where(even).drop(MOBILE_COLUMN), path)
                write_days(rows.where(~even), path)
            else:
                write_days(rows, path)
        _lakes[place] = root
    return _lakes[place]


def lake_run(spark: SparkSession, sf_dir: str, dates: str, processed: str | None = None) -> Run:
    return Run(spark, lake_of(spark, sf_dir), processed or scratch(spark), tuple(run_dates(dates)))


def scan_event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = EventLake(spark, lake_of(spark, sf_dir))
    scans = (lake.scan(LAKE_FEED.segment_type, name, run_dates(WHOLE_MONTH)) for name in LAKE_FEED.platforms)
    return union_present(found.rows.select("id", "received_at", RUN_DATE, PLATFORM) for found in scans).select(
        "id", "received_at", F.col(RUN_DATE).alias("run_date"), F.col(PLATFORM).alias("platform")
    )


def scan_by_platform(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = EventLake(spark, lake_of(spark, sf_dir))
    slices = lake.slices(LAKE_FEED, run_dates(WHOLE_MONTH))
    completed = union_present(LAKE_FEED.complete(found) for found in slices)
    return completed.groupBy(F.col(PLATFORM).alias("platform"), MOBILE_COLUMN).agg(F.count("*").alias("events"))


def scan_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole month of a feed whose position is a number on odd days and text on even ones."""
    lake, feed = EventLake(spark, scratch(spark)), Feed("video_event", ("web",))
    raw = adapters.raw_events(spark, sf_dir, feed.platforms).rows
    raw = raw.select("id", "received_at", "position", *rules.date_parts(F.col("received_at")))
    even = F.dayofmonth("received_at") % 2 == 0
    path = lake.feed_root("video_event", "web")
    write_days(raw.where(even).withColumn("position", F.col("position").cast("string")), path)
    write_days(raw.where(~even), path)
    slices = lake.slices(feed, run_dates(WHOLE_MONTH))
    return union_present(found.rows.select("id", "received_at", RUN_DATE, "position") for found in slices).withColumnRenamed(
        RUN_DATE, "run_date"
    )


def missing_platform_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = EventLake(spark, lake_of(spark, sf_dir))
    wider = Feed(LAKE_FEED.segment_type, (*LAKE_FEED.platforms, "lr_roku"))
    slices = lake.slices(wider, run_dates(WHOLE_MONTH))
    rows = union_present(found.rows.select(PLATFORM, RUN_DATE) for found in slices)
    return rows.groupBy(F.col(PLATFORM).alias("platform"), F.col(RUN_DATE).alias("run_date")).agg(
        F.count("*").alias("events")
    )


def export_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/dim_user"
    rows = adapters.users(spark, sf_dir)
    write_snapshot(rows.where("user_key < 0"), path)
    write_snapshot(rows, path)
    return spark.read.parquet(path)


def scan_dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/dim_user"
    rows = adapters.named(adapters.table(spark, sf_dir, "customer"), adapters.USER_COLUMNS, "c_name", "c_mktsegment")
    write_snapshot(rows, path)
    return load_users(spark, path)


def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/click_event"
    write_days(run_job(spark, sf_dir, "click_event"), path)
    return published_days(spark, path)


def published_days(spark: SparkSession, path: str) -> DataFrame:
    """A day table with its partition values in their written form, however the session infers them."""
    as_text = {name: F.lpad(F.col(name).cast("string"), 2, "0") for name in ("month", "day")}
    return spark.read.parquet(path).withColumns({"year": F.col("year").cast("int"), **as_text})


def sink_dynamic_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days are written, then the second half of the month again with another label."""
    path = f"{scratch(spark)}/click_event"
    rows = run_job(spark, sf_dir, "click_event")
    rows = rows.select("event_id", "event_timestamp", "platform", "year", "month", "day")
    write_days(rows, path)
    late = rows.where(F.dayofmonth("event_timestamp") >= 16)
    write_days(late.withColumn("platform", F.concat(F.col("platform"), F.lit(" again"))), path)
    return published_days(spark, path)


def stage_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/click_event"
    write_days(run_job(spark, sf_dir, "click_event"), path)
    return read_days(spark, path, run_dates(WHOLE_MONTH), JOBS["click_event"].column_list)


def stage_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch(spark)}/stage"
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows.select("id", "received_at", "label")
    write_snapshot(rows, path)
    write_snapshot(rows.groupBy("label").agg(F.count("*").alias("events")), path)
    return spark.read.parquet(path)


def events_by_run_date(spark: SparkSession, sf_dir: str, days: list[date]) -> DataFrame:
    """Events of each day, with the day's place in the run and NULL for days outside of it."""
    day = F.date_format("received_at", "yyyy-MM-dd")
    rows = adapters.raw_events(spark, sf_dir, ("web",)).rows
    place = F.array_position(F.array(*(F.lit(day.isoformat()) for day in days)), day)
    place = F.nullif(place, F.lit(0).cast("bigint")).cast("int")
    return rows.groupBy(day.alias("run_date"), place.alias("place")).agg(F.count("*").alias("events"))


def run_dates_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_by_run_date(spark, sf_dir, run_dates("2024-01-30::2024-01-01"))


def run_dates_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_by_run_date(spark, sf_dir, run_dates("2024-01-12, 2024-01-03 ,2024-01-27"))


def backfill_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_run(spark, sf_dir, WHOLE_MONTH).build(JOBS["signup_button_clicked"])


def merge_insert_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's first half is published, then the whole month merged twice."""
    target = ParquetTarget(spark, f"{scratch(spark)}/target")
    stage = adapters.raw_events(spark, sf_dir, ("web",)).rows.select("id", "received_at", "user_tier", "label")
    target.append(first_per_key(stage.where(F.dayofmonth("received_at") <= 15), "id", "received_at"))
    for _ in range(2):
        merge(stage, target, "id", "received_at")
    return target.read()


def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``merge_insert_absent``, into a catalog table bucketed by its key, in the shared folder."""
    folder = scratch(spark)
    target = BucketedTarget(spark, f"checks_merge_{uuid4().hex}", "id", 8, folder)
    stage = adapters.raw_events(spark, sf_dir, ("web",)).rows.select("id", "received_at", "user_tier", "label")
    target.append(first_per_key(stage.where(F.dayofmonth("received_at") <= 15), "id", "received_at"))
    for _ in range(2):
        merge(stage, target, "id", "received_at")
    spark.sql(f"DROP TABLE {target.table}")  # its files stay, as the table only names their folder
    return spark.read.parquet(folder)


def merge_with_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deciles of the month's sessions, merged twice on session and start: rows that share both stay."""
    target = ParquetTarget(spark, f"{scratch(spark)}/target")
    stage = run_job(spark, sf_dir, "vod_deciles").select(*JOBS["vod_deciles"].column_list)
    target.append(stage.where(F.dayofmonth("start_timestamp") <= 15))
    for _ in range(2):
        merge(stage, target, "session_id", "start_timestamp", with_dupes=True)
    return target.read()


def publish_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of one job, the second over all days, each written and published."""
    job = JOBS["signup_button_clicked"]
    folder = scratch(spark)
    target = ParquetTarget(spark, f"{folder}/warehouse/{job.name}")
    for dates in (SECOND_HALF, WHOLE_MONTH):
        run = lake_run(spark, sf_dir, dates, f"{folder}/processed")
        run.publish(job, target, run.process(job))
    return target.read()


def group_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = jobs_named(list(GROUPS))
    return row_counts((job.name, run_job(spark, sf_dir, job.name)) for job in jobs)


OPERATORS: dict[str, Query] = {
    query.__name__: query
    for query in (
        scan_event_day, scan_by_platform, missing_platform_ok, scan_dim_user, export_dim_user, sink_roundtrip,
        sink_dynamic_overwrite, stage_load, stage_replace, run_dates_range, run_dates_list, backfill_dates,
        group_row_counts, default_missing_columns, default_mobile_flag, default_mobile_flag_tv, filter_bots,
        drop_null_keys, coalesce_event_time, pick_user_column, normalize_break_type, normalize_target_type,
        user_tier_event, user_tier_session, decile_weight, join_dim_user_left, session_stats_join,
        session_combinations, decile_bitmap, minute_counts, dedup_message_id, dedup_subscription, dedup_earliest,
        union_platforms, scalar_date_parts, scalar_truncate, scalar_casts, ascii_title, merge_insert_absent,
        merge_with_dupes, publish_event, default_false_flags, default_platform, sessions_mixed_types,
        concurrents_backfill, scan_type_drift, merge_bucketed,
    )
}
STATISTICS = {
    "session_heartbeat_count": "beats",
    "session_start": "start_timestamp",
    "session_end": "end_timestamp",
    "session_max_position": "max_position",
}
# One job is registered under the name of what it does.
JOB_QUERIES = {name: "vod_sessions_by_context" if name == "sandbox_vod_sessions" else name for name in JOBS}


def queries() -> dict[str, Query]:
    found = {query: partial(run_job, name=name) for name, query in JOB_QUERIES.items()}
    found |= {query: partial(session_statistic, name=name) for query, name in STATISTICS.items()}
    return found | OPERATORS | lakes.QUERIES
