"""Viewing sessions and deciles from heartbeats.

Heartbeats are first reduced to one row per session and combination of its descriptive columns,
by hash aggregation with map-side combining; everything after works on that far smaller frame.
Input days and platforms are part of every key, so all of them share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.functions.rules import (
    BEAT_SECONDS,
    MOBILE_PLATFORMS,
    date_parts,
    decile,
    decile_bit,
    decile_digits,
    session_tier,
)
from beatlake.operators.combine import union_present
from beatlake.operators.joins import inner_join_sharded, one_key_per_user, with_user_key
from beatlake.plans.model import MOBILE_COLUMN, Feed, ReadFeed, Rule, Source, declared, kind_of
from beatlake.sources.lake import PLATFORM, RUN_DATE, Slice, with_run_date

BEAT_COLUMNS = (
    "session_id", "content_id", "anonymous_id", "user_tier", "user_id", "user_uuid", "received_at", "position",
)
ALL_PLATFORMS = ("android", "ios", "web", "lr_apple", "lr_fire", "lr_roku", "lr_xbox", "lr_android")
SESSION = [RUN_DATE, PLATFORM, "session_id"]
USER = "_user_id"
POSITION_TYPE = "bigint"
POSITION_TEXT = "_position_text"


def platform_user(raw: Slice) -> Column:
    """The user column by platform: phones carry user_id, web and TVs user_uuid (absent: NULL)."""
    uuid = F.col("user_uuid") if "user_uuid" in raw.columns else F.lit(None).cast("string")
    phones = [platform for platform in raw.platforms if platform in MOBILE_PLATFORMS]
    if not phones:
        return uuid
    if len(phones) == len(raw.platforms):
        return F.col("user_id")
    return F.when(F.col(PLATFORM).isin(*phones), F.col("user_id")).otherwise(uuid)


def typed(name: str) -> Column:
    """A raw column in its one type, so that no comparison depends on which feeds are in the run."""
    return F.col(name).try_cast(kind_of(name)).alias(name)


def session_rows(feed: Feed, raw: Slice, context: Sequence[str], *extra: str | Column) -> DataFrame:
    """Heartbeats of known sessions, cut to the columns the aggregates need."""
    user = platform_user(raw)
    rows = feed.complete(raw).withColumn(USER, user).where(F.col("session_id").isNotNull())
    described = ["session_id", "content_id", "anonymous_id", "user_tier", USER, *context, "received_at"]
    return rows.select(RUN_DATE, PLATFORM, *(typed(name) for name in described), *extra)


def has_text_positions(raw: Slice) -> bool:
    return dict(raw.rows.dtypes).get("position") == "string"


def positions(raw: Slice, some_text: bool) -> list[Column]:
    """The position as a number and, if ``some_text`` feed of the run has text, as text; NULL where the other holds."""
    text = has_text_positions(raw)
    number = F.lit(None) if text else F.col("position")
    columns = [number.try_cast(POSITION_TYPE).alias("position")]
    if some_text:
        columns.append((F.col("position") if text else F.lit(None).cast("string")).alias(POSITION_TEXT))
    return columns


def combinations(beats: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per session and combination of ``columns``, with beats counted, timed and placed.

    Numbers are compared as numbers and text as text, as in a run of one feed alone.
    """
    texts = [F.max(POSITION_TEXT).alias(POSITION_TEXT)] if POSITION_TEXT in beats.columns else []
    return beats.groupBy(*SESSION, *columns).agg(
        F.count("*").alias("beats"),
        F.min("received_at").alias("first_beat"),
        F.max("received_at").alias("last_beat"),
        F.max("position").alias("max_position"),
        *texts,
    )


def session_statistics(combined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per session: totals over its combinations, and the combination that stands for it.

    That one is the smallest by ``columns`` in order, NULLs last. Every aggregate combines
    before the shuffle, so a session that holds most of the input is no hot task.
    """
    texts = [F.max(POSITION_TEXT).alias(POSITION_TEXT)] if POSITION_TEXT in combined.columns else []
    ordered = [part for name in columns for part in (F.col(name).isNull().alias(f"{name}_missing"), F.col(name))]
    totals = combined.groupBy(*SESSION).agg(
        F.sum("beats").alias("beats"),
        F.min("first_beat").alias("start_timestamp"),
        F.max("last_beat").alias("end_timestamp"),
        F.max("max_position").alias("max_position"),
        F.min(F.struct(*ordered)).alias("kept"),
        *texts,
    )
    if texts:
        number = F.col(POSITION_TEXT).try_cast("double").try_cast(POSITION_TYPE)
        totals = totals.withColumn("max_position", F.greatest("max_position", number)).drop(POSITION_TEXT)
    return totals.select("*", *(F.col("kept")[name].alias(name) for name in columns)).drop("kept")


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


@dataclass(frozen=True)
class SessionJob:
    """One row per session, platform and input day, with its extent and the matched user."""

    name: str
    context: tuple[str, ...]
    context_output: tuple[tuple[str, Source], ...]
    feed: Feed
    published: tuple[str, ...]
    key: str = "session_id"
    sort_key: str = "start_timestamp"
    needs_users: bool = True

    @property
    def column_list(self) -> tuple[str, ...]:
        return self.published

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        described = ["content_id", "anonymous_id", USER, "user_tier", *self.context]
        found = read(self.feed)
        some_text = any(has_text_positions(raw) for raw in found)
        beats = union_present(
            session_rows(self.feed, raw, self.context, *positions(raw, some_text)) for raw in found
        )
        if beats is None:
            return None
        combined = combinations(beats, described)
        sessions = session_statistics(combined, described).where(
            F.col("content_id").isNotNull() & F.col("start_timestamp").isNotNull()
        )
        matched = with_user_key(sessions, USER, one_key_per_user(users), SESSION)
        year, month, day = date_parts(F.col("start_timestamp"))
        return matched.select(
            F.concat(F.col("session_id"), year.cast("string"), month, day).alias("session_id"),
            *declared(["user_key"]),
            session_tier(F.col("user_tier"), F.col("user_key")).alias("user_tier"),
            "anonymous_id",
            F.col("content_id").alias("episode_key"),
            (F.col("beats") * BEAT_SECONDS).alias("active_seconds"),
            "start_timestamp",
            "end_timestamp",
            (seconds_between(F.col("start_timestamp"), F.col("end_timestamp")) + BEAT_SECONDS).alias("duration_seconds"),
            "max_position",
            F.col(PLATFORM).alias("platform"),
            *(F.col(s).alias(n) if isinstance(s, str) else s().alias(n) for n, s in self.context_output),
            year,
            month,
            day,
            *with_run_date(tagged),
        )


@dataclass(frozen=True)
class DecileJob:
    """Which tenths of a video a session reached, one digit per decile.

    One row per session and resolved combination of user, tier and content, so a session can
    have several.
    """

    name: str
    feed: Feed
    key: str = "session_id"
    sort_key: str = "start_timestamp"
    needs_users: bool = True

    @property
    def column_list(self) -> tuple[str, ...]:
        return (
            "session_id", "user_key", "user_tier", "anonymous_id", "episode_key", "start_timestamp",
            "platform", MOBILE_COLUMN, "decile",
        )

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        described = ["content_id", "anonymous_id", USER, "user_tier", MOBILE_COLUMN]
        seen = decile_bit(decile(F.col("percentage_watched"))).alias("bit")
        beats = union_present(session_rows(self.feed, raw, [MOBILE_COLUMN], seen) for raw in read(self.feed))
        if beats is None:
            return None
        combined = beats.groupBy(*SESSION, *described).agg(
            F.bit_or("bit").alias("bits"),
            F.min("received_at").alias("first_beat"),
            F.max(F.col("content_id").isNotNull()).alias("shown"),
        )
        # The start is the whole session's, rows without content included. It comes from the same combinations, not
        # from a window over them, which would put all of a hot session into one task. Both sides of the join use
        # all three aggregates, so that neither is cut below the shuffle and Spark makes it once for both.
        starts = combined.groupBy(*SESSION).agg(
            F.min("first_beat").alias("start_timestamp"), F.bit_or("bits").alias("all_bits"), F.max("shown").alias("any_shown")
        )
        timed = inner_join_sharded(combined.where("shown"), starts, SESSION)
        timed = timed.where("any_shown AND all_bits IS NOT NULL")
        timed = timed.withColumn("start_timestamp", F.least("start_timestamp", "first_beat"))
        matched = with_user_key(timed, USER, users, [*SESSION, "anonymous_id"])
        resolved = matched.select(
            *SESSION,
            *declared(["user_key"]),
            session_tier(F.col("user_tier"), F.col("user_key")).alias("user_tier"),
            "anonymous_id",
            F.col("content_id").alias("episode_key"),
            "start_timestamp",
            MOBILE_COLUMN,
            "bits",
        )
        # One input day and platform at a time, as two days may hold the same session.
        grouped = resolved.groupBy(*(name for name in resolved.columns if name != "bits")).agg(
            F.bit_or("bits").alias("bits")
        )
        return grouped.select(
            "session_id",
            "user_key",
            "user_tier",
            "anonymous_id",
            "episode_key",
            "start_timestamp",
            F.col(PLATFORM).alias("platform"),
            MOBILE_COLUMN,
            decile_digits(F.col("bits")).alias("decile"),
            *date_parts(F.col("start_timestamp")),
            *with_run_date(tagged),
        )


CORE_SESSION_COLUMNS = (
    "session_id", "user_key", "user_tier", "anonymous_id", "episode_key", "active_seconds",
    "start_timestamp", "end_timestamp", "duration_seconds", "max_position", "platform",
)

VOD_SESSIONS = SessionJob(
    "vod_sessions",
    (MOBILE_COLUMN,),
    ((MOBILE_COLUMN, MOBILE_COLUMN),),
    Feed("video_heartbeat", ALL_PLATFORMS, mobile=True, tv_flag=True),
    (*CORE_SESSION_COLUMNS, MOBILE_COLUMN),
)

# The published table of this one leaves the three context columns out.
SANDBOX_VOD_SESSIONS = SessionJob(
    "sandbox_vod_sessions",
    ("context_ip", "context_locale", "context_page_referrer"),
    (
        ("context_ip", "context_ip"),
        ("context_locale", "context_locale"),
        ("context_page_referrer", Rule(("context_page_referrer",), lambda: F.substring("context_page_referrer", 1, 512))),
    ),
    Feed(
        "video_heartbeat",
        ALL_PLATFORMS,
        nulls=("context_ip", "context_locale", "context_page_referrer", "user_id", "user_uuid"),
        reads=(*BEAT_COLUMNS, "context_ip", "context_locale", "context_page_referrer"),
    ),
    CORE_SESSION_COLUMNS,
)

VOD_DECILES = DecileJob("vod_deciles", Feed("video_heartbeat", ("web",), mobile=True, tv_flag=True))
