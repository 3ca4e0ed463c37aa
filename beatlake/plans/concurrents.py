"""Concurrent viewers per minute, counted from heartbeats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.functions.rules import date_parts
from beatlake.operators.combine import union_present
from beatlake.plans.model import Feed, ReadFeed
from beatlake.sources.lake import PLATFORM, RUN_DATE, with_run_date

BUCKET = "1 minute"
BEATS_PER_MINUTE = 2
PLATFORMS = ("android", "ios", "web", "lr_apple", "lr_fire", "lr_roku", "lr_xbox")


def bucket_counts(beats: DataFrame, bucket: str = BUCKET, *more: str) -> DataFrame:
    """Heartbeats per platform and time bucket; empty buckets have no row.

    Late beats count in the bucket they belong to, whichever input day of the run brought them: a bucket
    per input day would give rows that share key and time, of which a merge keeps but one. Counts combine
    before the shuffle, which then moves one row per bucket and task.
    """
    window = F.window("received_at", bucket)
    return (
        beats.groupBy(PLATFORM, window, *more)
        .agg(F.count("received_at").alias("beats"))
        .withColumn("start_timestamp", F.col("window.start"))
        .drop("window")
    )


@dataclass(frozen=True)
class ConcurrentsJob:
    """Viewers per platform and bucket: the beats of a minute over the beats a viewer sends."""

    name: str
    feed: Feed
    bucket: str = BUCKET
    key: str = "session_id"
    sort_key: str = "start_timestamp"
    needs_users: bool = False

    @property
    def column_list(self) -> tuple[str, ...]:
        return ("session_id", "start_timestamp", "count", "platform")

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        beats = union_present(
            raw.rows.select(F.col("received_at").try_cast("timestamp").alias("received_at"), PLATFORM, RUN_DATE)
            for raw in read(self.feed)
        )
        if beats is None:
            return None
        if not tagged:
            return self._viewers(bucket_counts(beats, self.bucket), *date_parts(F.col("start_timestamp")))
        # A day table keeps the beats that each input day brought, which ``staged`` adds up.
        counts = bucket_counts(beats, self.bucket, RUN_DATE)
        return counts.select(
            "start_timestamp", "beats", F.col(PLATFORM).alias("platform"), *date_parts(F.col("start_timestamp")),
            *with_run_date(True),
        )

    def _viewers(self, counts: DataFrame, *more: Column) -> DataFrame:
        start = F.col("start_timestamp")
        return counts.select(
            F.concat(start.cast("string"), F.col(PLATFORM)).alias("session_id"),
            start,
            F.floor(F.col("beats") / BEATS_PER_MINUTE).cast("int").alias("count"),
            F.col(PLATFORM).alias("platform"),
            *more,
        )

    def staged(self, days: DataFrame) -> DataFrame:
        """Published rows of a day table: a minute's beats of all input days together."""
        total = days.groupBy("start_timestamp", F.col("platform").alias(PLATFORM)).agg(F.sum("beats").alias("beats"))
        return self._viewers(total)


LIVE_CONCURRENTS = ConcurrentsJob("live_concurrents", Feed("livestream_heartbeat", PLATFORMS, reads=("received_at",)))
VOD_CONCURRENTS = ConcurrentsJob("vod_concurrents", Feed("video_heartbeat", PLATFORMS, reads=("received_at",)))
