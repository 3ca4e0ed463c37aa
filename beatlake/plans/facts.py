"""Visit, subscription and live-heartbeat facts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.functions.rules import date_parts, is_not_bot, whole_number
from beatlake.operators.combine import union_present
from beatlake.operators.dedup import keep_least
from beatlake.operators.joins import one_key_per_user, with_user_key
from beatlake.plans.catalog import AT, HERE, columns
from beatlake.plans.events import AGENT_COLUMN, EventJob, Part
from beatlake.plans.model import Feed, ReadFeed, declared
from beatlake.plans.sessions import ALL_PLATFORMS, USER
from beatlake.sources.lake import PLATFORM, RUN_DATE, Slice, with_run_date

# Every heartbeat is kept; the keyed merge removes the repeats.
LIVESTREAM_HEARTBEAT = EventJob(
    "livestream_heartbeat",
    "heartbeat_id",
    (
        Part(
            Feed("livestream_heartbeat", ALL_PLATFORMS, ("user_uuid", "user_id")),
            columns(("heartbeat_id", "id"), "session_id anonymous_id user_id user_uuid user_tier", AT, HERE),
        ),
    ),
    dedup=False,
)


def schema_user(raw: Slice) -> Column:
    """user_id where the files have it, otherwise user_uuid; never a mix of the two."""
    for name in ("user_id", "user_uuid"):
        if name in raw.columns:
            return F.col(name)
    return F.lit(None).cast("string")


@dataclass(frozen=True)
class VisitsJob:
    """One row per page or screen visit of a person, with the matched user."""

    name: str
    feed: Feed
    key: str = "message_id"
    sort_key: str = "timestamp"
    needs_users: bool = True

    @property
    def column_list(self) -> tuple[str, ...]:
        return ("message_id", "anonymous_id", "timestamp", "platform", "user_key")

    def _visits(self, raw: Slice) -> DataFrame:
        user = schema_user(raw)
        rows = self.feed.complete(raw).where(is_not_bot(F.col(AGENT_COLUMN)))
        return rows.select(
            RUN_DATE,
            PLATFORM,
            F.col("id").cast("string").alias("message_id"),
            F.col("anonymous_id").cast("string").alias("anonymous_id"),
            F.col("received_at").try_cast("timestamp").alias("timestamp"),
            user.cast("string").alias(USER),
        )

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        visits = union_present(self._visits(raw) for raw in read(self.feed))
        if visits is None:
            return None
        # One visit per message first: the join then moves no repeats.
        kept = keep_least(
            visits.where(F.col("message_id").isNotNull()), [RUN_DATE, PLATFORM, "message_id"], ["timestamp"]
        ).where(F.col("anonymous_id").isNotNull())
        matched = with_user_key(kept, USER, one_key_per_user(users), ["message_id"])
        rows = matched.withColumn("platform", F.col(PLATFORM))
        return rows.select(*declared(self.column_list), *date_parts(F.col("timestamp")), *with_run_date(tagged))


@dataclass(frozen=True)
class SubscriptionJob:
    """Subscription changes with typed values; text that does not fit its type is NULL."""

    name: str
    feed: Feed
    key: str = "id"
    sort_key: str = "event_timestamp"
    needs_users: bool = True

    identity = ("subscription_id", "subscription_event", "subscription_event_type")

    @property
    def column_list(self) -> tuple[str, ...]:
        return (
            "user_key", "id", "subscription_id", "subscription_event", "subscription_event_type",
            "start_timestamp", "end_timestamp", "event_timestamp", "trial", "payment_provider",
            "membership_plan", "amount_cents", "coupon_code", "stripe_user", "sent_at", "user_id",
        )

    def _changes(self, raw: Slice) -> DataFrame:
        def typed(name: str, kind: str) -> Column:
            return F.col(name).try_cast(kind).alias(name)

        amount_type = dict(raw.rows.dtypes)["amount_cents"]
        return self.feed.complete(raw).select(
            RUN_DATE,
            typed("id", "string"),
            typed("subscription_id", "string"),
            F.col("_event").cast("string").alias("subscription_event"),
            F.col("event_type").cast("string").alias("subscription_event_type"),
            typed("start_timestamp", "timestamp"),
            typed("end_timestamp", "timestamp"),
            F.coalesce(
                F.col("original_timestamp").try_cast("timestamp"), F.col("received_at").try_cast("timestamp")
            ).alias("event_timestamp"),
            typed("trial", "boolean"),
            typed("payment_provider", "string"),
            typed("membership_plan", "string"),
            whole_number(F.col("amount_cents"), amount_type).alias("amount_cents"),
            typed("coupon_code", "string"),
            typed("stripe_user", "boolean"),
            typed("sent_at", "timestamp"),
            typed("user_id", "string"),
            typed("received_at", "timestamp"),
        )

    def build(self, read: ReadFeed, users: DataFrame | None = None, tagged: bool = False) -> DataFrame | None:
        changes = union_present(self._changes(raw) for raw in read(self.feed))
        if changes is None:
            return None
        changes = changes.na.drop(subset=list(self.identity))
        kept = keep_least(changes, [RUN_DATE, *self.identity], ["event_timestamp"])
        matched = with_user_key(kept, "user_id", one_key_per_user(users), ["id"])
        return matched.select(*declared(self.column_list), *date_parts(F.col("received_at")), *with_run_date(tagged))


FACT_VISITS = VisitsJob(
    "fact_visits",
    Feed({"web": "pages", "*": "screens"}, ALL_PLATFORMS, nulls=(AGENT_COLUMN,), user_by_schema=True),
)
SUBSCRIPTION = SubscriptionJob("subscription", Feed("subscription", ("backend",), nulls=("coupon_code",)))
