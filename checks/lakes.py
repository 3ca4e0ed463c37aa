"""Raw lakes of several feeds derived from the test tables, and runs over them, day table by day table."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatlake.functions import rules
from beatlake.operators.merge import ParquetTarget
from beatlake.plans.model import MOBILE_COLUMN
from beatlake.plans.registry import JOBS
from beatlake.plans.runs import Run
from beatlake.plans.sessions import ALL_PLATFORMS, BEAT_COLUMNS
from beatlake.session import shared_folder
from beatlake.sources.dates import run_dates
from beatlake.sources.lake import INPUT_DAY, PLATFORM, EventLake
from beatlake.sources.tables import write_days
from checks import adapters

EARLY, LATE, MONTH = "2024-01-01::2024-01-15", "2024-01-16::2024-01-31", "2024-01-01::2024-01-31"
CLICKS = JOBS["signup_button_clicked"]
VISIT_COLUMNS = ("id", "anonymous_id", "received_at", "user_id", "user_uuid", "context_user_agent")
DECILE_COLUMNS = (*BEAT_COLUMNS, "id", MOBILE_COLUMN, "percentage_watched")

_lakes: dict[tuple[str, str, str], str] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder of this run in the cluster's shared folder."""
    return f"{shared_folder(spark)}/beatlake-checks/{uuid4().hex}"


def written_once(build: Callable[[SparkSession, str, EventLake], None]) -> Callable[[SparkSession, str], str]:
    """The root of a lake that is written once per session and tables."""

    def root_of(spark: SparkSession, sf_dir: str) -> str:
        place = (spark.sparkContext.applicationId, sf_dir, build.__name__)
        if place not in _lakes:
            root = scratch(spark)
            build(spark, sf_dir, EventLake(spark, root))
            _lakes[place] = root
        return _lakes[place]

    return root_of


def write_feed(lake: EventLake, segment_type: str, platform: str, rows: DataFrame, folder_day: Column) -> None:
    """The rows of a platform as files of a feed, in the folders of the days they are loaded on."""
    year, month, day = rules.date_parts(folder_day)
    dated = rows.where(F.col(PLATFORM) == platform).withColumns({"year": year, "month": month, "day": day})
    write_days(dated.drop(PLATFORM), lake.feed_root(segment_type, platform))


def run_over(spark: SparkSession, sf_dir: str, root: str, dates: str, processed: str, users: bool = False) -> Run:
    run = Run(spark, root, processed, tuple(run_dates(dates)))
    if users:
        run.export_users(adapters.users(spark, sf_dir))
    return run


@written_once
def late_clicks(spark: SparkSession, sf_dir: str, lake: EventLake) -> None:
    """Clicks of which a seventh are loaded a day late and an eleventh have no id."""
    raw = adapters.raw_events(spark, sf_dir, CLICKS.parts[0].feed.platforms).rows
    raw = raw.withColumn("id", F.when(F.col("position") % 11 != 0, F.col("id")))
    day = F.to_date("received_at")
    late = F.least(F.date_add(day, 1), F.lit("2024-01-31").cast("date"))
    for platform in CLICKS.parts[0].feed.platforms:
        rows = raw.select("id", "anonymous_id", "context_page_url", "location", "received_at", MOBILE_COLUMN, PLATFORM, "position")
        write_feed(lake, "signup_button_clicked", platform, rows, F.when(F.col("position") % 7 == 0, late).otherwise(day))


@written_once
def drifting_heartbeats(spark: SparkSession, sf_dir: str, lake: EventLake) -> None:
    """Live heartbeats whose tier is a number until the 15th and text afterwards."""
    raw = adapters.raw_heartbeats(spark, sf_dir, ("web", "ios")).rows
    early = F.dayofmonth("received_at") <= 15
    columns = ["id", "session_id", "anonymous_id", "user_id", "user_uuid", "received_at", PLATFORM]
    for platform in ("web", "ios"):
        numbers = raw.where(early).select(*columns, (F.col("position") % 5).cast("int").alias("user_tier"))
        write_feed(lake, "livestream_heartbeat", platform, numbers, F.col("received_at"))
        write_feed(lake, "livestream_heartbeat", platform, raw.where(~early).select(*columns, "user_tier"), F.col("received_at"))


@written_once
def visits(spark: SparkSession, sf_dir: str, lake: EventLake) -> None:
    """Pages and screens on every platform; the kind that a platform's visits don't come from holds other rows."""
    raw = adapters.raw_events(spark, sf_dir, ALL_PLATFORMS).rows.select(*VISIT_COLUMNS, "build", PLATFORM)
    for platform in ALL_PLATFORMS:
        right, wrong = ("pages", "screens") if platform == "web" else ("screens", "pages")
        write_feed(lake, right, platform, raw.where("build % 2 = 0").drop("build"), F.col("received_at"))
        write_feed(lake, wrong, platform, raw.where("build % 2 = 1").drop("build"), F.col("received_at"))


@written_once
def heartbeats(spark: SparkSession, sf_dir: str, lake: EventLake) -> None:
    """Heartbeats of live streams, a third of them, and of videos."""
    raw = adapters.raw_heartbeats(spark, sf_dir, ALL_PLATFORMS).rows.select(*DECILE_COLUMNS, PLATFORM)
    live = F.col("position") % 3 == 0
    for platform in ALL_PLATFORMS:
        write_feed(lake, "livestream_heartbeat", platform, raw.where(live), F.col("received_at"))
        write_feed(lake, "video_heartbeat", platform, raw.where(~live), F.col("received_at"))


def rerun_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's halves run one after the other, then the second and the first again."""
    root, processed = late_clicks(spark, sf_dir), scratch(spark)
    for dates in (EARLY, LATE, LATE, EARLY):
        run = run_over(spark, sf_dir, root, dates, processed)
        run.process(CLICKS)
    table = spark.read.parquet(run.path(CLICKS.name))
    as_text = {name: F.lpad(F.col(name).cast("string"), 2, "0") for name in ("month", "day")}
    return table.withColumns({"year": F.col("year").cast("int"), INPUT_DAY: F.col(INPUT_DAY).cast("string"), **as_text})


def publish_type_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with tiers as numbers and as text, run and published separately and then together."""
    job, root, folder = JOBS["livestream_heartbeat"], drifting_heartbeats(spark, sf_dir), scratch(spark)
    target = ParquetTarget(spark, f"{folder}/published")
    for dates in (EARLY, LATE, MONTH):
        run = run_over(spark, sf_dir, root, dates, f"{folder}/processed")
        run.publish(job, target, run.process(job))
    return target.read()


def built(spark: SparkSession, sf_dir: str, root: str, name: str) -> DataFrame:
    return run_over(spark, sf_dir, root, MONTH, scratch(spark), users=True).build(JOBS[name])


def visits_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, visits(spark, sf_dir), "fact_visits")


def sessions_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, heartbeats(spark, sf_dir), "vod_sessions")


def deciles_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir, heartbeats(spark, sf_dir), "vod_deciles")


def _staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The day table's rows of a month, its halves run separately."""
    root, processed = heartbeats(spark, sf_dir), scratch(spark)
    for dates in (EARLY, LATE):
        run_over(spark, sf_dir, root, dates, processed).process(JOBS[name])
    return run_over(spark, sf_dir, root, MONTH, processed).staged(JOBS[name])


def live_concurrents_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "live_concurrents")


def vod_concurrents_from_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir, "vod_concurrents")


QUERIES = {
    query.__name__: query
    for query in (
        rerun_days, publish_type_drift, visits_from_lake, sessions_backfill, deciles_backfill,
        live_concurrents_from_lake, vod_concurrents_from_lake,
    )
}
