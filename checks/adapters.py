"""Raw event, heartbeat, subscription and user rows derived from the test tables.

Each column is one SQL expression that reads the same in Spark and DuckDB, so the queries and
their SQL counterparts start from equal rows. Every adapter covers its whole table: rows are
spread over the platforms a feed has, none are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatlake.sources.lake import PLATFORM, RUN_DATE, Slice

# One event in ten repeats the id of the one before it, with another payload.
NUMBERED = {
    "base_id": "CASE WHEN event_id % 10 = 1 THEN event_id - 1 ELSE event_id END",
    "k": """CAST(replace(replace(props, '{"k": ', ''), '}', '') AS INT)""",
}


def cycle(number: str, *values: str | None) -> str:
    """The values in turn by a running number, None for NULL."""
    cases = " ".join(
        f"WHEN {at} THEN {'NULL' if value is None else repr(value)}" for at, value in enumerate(values)
    )
    return f"CASE {number} % {len(values)} {cases} END"


def sometimes_null(name: str, at: int, every: int = 13) -> str:
    return f"CASE WHEN event_id % {every} = {at % every} THEN NULL ELSE '{name}-' || CAST(event_id % 7 AS STRING) END"


USER_TIER = cycle("event_id", None, "free", "FIRST", "Premium", "Free", "first")
USER_ID = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(user_id AS STRING) END"
USER_UUID = "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS STRING) END"
LONG_TEXT = "repeat(event_type || '{}', k)"
MOBILE = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 3 = 1 END"

PLAIN_TEXT = (
    "action actor coupon_code offer_code new_plan_code new_plan_end new_plan_start old_plan_code old_plan_end "
    "old_plan_start room_id option_selected stream_title name shopify_id carousel_item_index carousel_item_page "
    "carousel_per_page content_block_display_type content_block_uuid content_block_item_use_type item_type "
    "item_uuid item_id item_name item_use location target_url static_spotlight_element_clicked "
    "static_spotlight_element_copy experiment_id variation_id carousel_name feed_tier page episode_title "
    "episode_uuid cta_type url context_page_path target target_name target_uuid target_id hero_item_name link "
    "loading source signup_source playlist_id playlist_name selected_tab series_uuid show_id sort "
    "filter_channel_id filter_genre state step campaign code_applied device full_screen resolution volume "
    "context_app_version context_device_manufacturer context_device_model context_network_cellular "
    "context_network_wifi context_os_name context_os_version context_traits_member_tier from_background "
    "content_type"
).split()

EVENT_COLUMNS = {
    "id": "'m' || CAST(base_id AS STRING)",
    "received_at": "ts",
    "timestamp": "ts",
    "sent_at": "ts",
    "original_timestamp": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END",
    "anonymous_id": "'a' || CAST(user_id AS STRING)",
    "user_id": USER_ID,
    "user_uuid": USER_UUID,
    "user_tier": USER_TIER,
    "member_tier": USER_TIER,
    "platform": cycle("base_id", "Web", "iOS", "Android"),
    "context_user_agent": cycle(
        "event_id", None, "Mozilla", "Googlebot", "Crawler", "webcrawl", "spider/1", "Safari", "Safari", "Safari"
    ),
    "on_mobile_device": MOBILE,
    "has_sso": MOBILE,
    "has_video": "event_id % 2 = 0",
    "session_id": "'s' || CAST(user_id AS STRING)",
    "content_id": "CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'ep' || CAST(event_id % 4 AS STRING) END",
    "position": "CAST(floor(value) AS BIGINT)",
    "playhead_time": "CASE WHEN event_id % 8 = 0 THEN 'live' ELSE CAST(value AS STRING) END",
    "build": "k",
    "break_type": cycle("event_id", "preroll", "PREROLL", "midroll", "MIDROLL", "Preroll", None),
    "target_type": cycle("event_id", "show", "shows", "episode", "epısode", "movie", None),
    "label": LONG_TEXT.format("-"),
    "context": LONG_TEXT.format(":"),
    "path": LONG_TEXT.format("/"),
    "previous_url": LONG_TEXT.format("?"),
    "link_to": LONG_TEXT.format("#"),
    "query_used": LONG_TEXT.format("é "),
    "context_page_url": LONG_TEXT.format("&"),
    **{name: sometimes_null(name, at) for at, name in enumerate(PLAIN_TEXT)},
}

# Titles come from the pages that share a number with an event; the other events have made-up ones.
TITLE = """CASE WHEN event_id % 41 = 0 THEN '' WHEN event_id % 43 = 0 THEN 'éé'
 WHEN html IS NULL THEN 'Café ' || event_type || ' – ' || repeat('épisode ', k)
 ELSE repeat(regexp_extract(html, '<title>(.*?)</title>', 1) || ' ', 1 + k % 6) END"""

HEARTBEAT_COLUMNS = {
    "id": "'h' || CAST(base_id AS STRING)",
    "received_at": "ts",
    "session_id": (
        "CASE WHEN event_id % 97 = 0 THEN NULL ELSE 's' || CAST(user_id AS STRING) || '-' || "
        "CAST(CAST(floor((day(ts) - 1) / 7) AS INT) AS STRING) END"
    ),
    "content_id": EVENT_COLUMNS["content_id"],
    "anonymous_id": "'a' || CAST(user_id AS STRING) || '-' || CAST(event_id % 3 AS STRING)",
    "user_id": USER_ID,
    "user_uuid": USER_UUID,
    "user_tier": USER_TIER,
    "on_mobile_device": MOBILE,
    "position": EVENT_COLUMNS["position"],
    "percentage_watched": (
        "CAST(CAST(k * 10 + 5 * (event_id % 2) AS DOUBLE) / CAST(1000 AS DOUBLE) AS STRING)"
    ),
    "context_ip": "'10.0.0.' || CAST(event_id % 5 AS STRING)",
    "context_locale": cycle("event_id", "en-US", "fr-FR", None),
    "context_page_referrer": LONG_TEXT.format("/"),
}
# Hourly beats, so that a minute holds several and the halving shows.
DENSE_BEAT = "date_trunc('hour', ts)"

SUBSCRIPTION_COLUMNS = {
    "id": "'e' || CAST(o_orderkey AS STRING)",
    "subscription_id": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE 'sub' || CAST(o_custkey AS STRING) END",
    "_event": cycle("o_orderkey", "created", "renewed", "cancelled"),
    "event_type": "o_orderstatus",
    "start_timestamp": "CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 08:00:00'",
    "end_timestamp": (
        "CASE WHEN o_orderkey % 6 = 0 THEN 'open' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 23:59:59' END"
    ),
    "original_timestamp": (
        "CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'not a time' "
        "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:11:12' END"
    ),
    "received_at": "o_orderdate",
    "trial": cycle("o_orderkey", "true", "false", "maybe", None),
    "stripe_user": cycle("o_orderkey", "t", "0", "no"),
    "payment_provider": "o_orderpriority",
    "membership_plan": cycle("o_orderkey", "monthly", "yearly"),
    "amount_cents": (
        "CASE o_orderkey % 9 WHEN 0 THEN 'n/a' WHEN 1 THEN '12.7' WHEN 2 THEN '99999999999' "
        "ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END"
    ),
    "coupon_code": cycle("o_orderkey", None, "SAVE10"),
    "sent_at": "CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 12:00:00'",
    "user_id": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END",
}

# A third of the customers are known under an id that no event carries.
USER_COLUMNS = {
    "user_key": "c_custkey",
    "user_id": "CASE WHEN c_custkey % 3 = 0 THEN 'x' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END",
}


def by_platform(number: str, platforms: tuple[str, ...]) -> str:
    return f"'{platforms[0]}'" if len(platforms) == 1 else cycle(number, *platforms)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(rows: DataFrame, columns: dict[str, str], *kept: str) -> DataFrame:
    return rows.selectExpr(*kept, *(f"{text} AS `{name}`" for name, text in columns.items()))


def derived(rows: DataFrame, columns: dict[str, str], platform: str) -> DataFrame:
    """The raw rows: all of them one input day, unless the caller sets the run date."""
    return named(rows, {**columns, PLATFORM: platform, RUN_DATE: "'one run'"})


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(table(spark, sf_dir, "events"), NUMBERED, "*")


def raw_events(spark: SparkSession, sf_dir: str, platforms: tuple[str, ...], titles: bool = False) -> Slice:
    rows = numbered_events(spark, sf_dir)
    columns = EVENT_COLUMNS
    if titles:
        pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("event_id"), "html")
        rows = rows.join(pages, "event_id", "left")
        columns = {**columns, "title": TITLE}
    return Slice(derived(rows, columns, by_platform("base_id", platforms)), platforms)


def raw_heartbeats(spark: SparkSession, sf_dir: str, platforms: tuple[str, ...], dense: bool = False) -> Slice:
    columns = {**HEARTBEAT_COLUMNS, "received_at": DENSE_BEAT} if dense else HEARTBEAT_COLUMNS
    rows = derived(numbered_events(spark, sf_dir), columns, by_platform("user_id", platforms))
    return Slice(rows, platforms)


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> Slice:
    rows = derived(table(spark, sf_dir, "orders"), SUBSCRIPTION_COLUMNS, "'backend'")
    return Slice(rows, ("backend",))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return named(table(spark, sf_dir, "customer"), USER_COLUMNS)
