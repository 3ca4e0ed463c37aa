"""SQL counterparts of the queries for DuckDB, written apart from the library.

Only the raw columns come from the adapters; every rule, key and order is stated here again.
"""

from __future__ import annotations

from checks import adapters

ALL = ("android", "ios", "web", "lr_apple", "lr_fire", "lr_roku", "lr_xbox", "lr_android")
SEVEN = ALL[:-1]
TVS = ("lr_apple", "lr_fire", "lr_roku", "lr_xbox", "lr_android")
THREE = ("web", "android", "ios")


def listed(columns: dict[str, str]) -> str:
    return ",\n ".join(f'{text} AS "{name}"' for name, text in columns.items())


def numbered() -> str:
    return f"(SELECT *, {listed(adapters.NUMBERED)} FROM events)"


def events(platforms: tuple[str, ...], titles: bool = False) -> str:
    columns = {**adapters.EVENT_COLUMNS, "pf": adapters.by_platform("base_id", platforms)}
    source = f"{numbered()} n"
    if titles:
        columns["title"] = adapters.TITLE
        source += " LEFT JOIN pages ON page_id = event_id"
    return f"(SELECT {listed(columns)}\n FROM {source})"


def heartbeats(platforms: tuple[str, ...], dense: bool = False) -> str:
    columns = {**adapters.HEARTBEAT_COLUMNS, "pf": adapters.by_platform("user_id", platforms)}
    if dense:
        columns["received_at"] = adapters.DENSE_BEAT
    return f"(SELECT {listed(columns)}\n FROM {numbered()} n)"


def subscriptions() -> str:
    return f"(SELECT {listed(adapters.SUBSCRIPTION_COLUMNS)} FROM orders)"


def users() -> str:
    return f"(SELECT {listed(adapters.USER_COLUMNS)} FROM customer)"


def date_parts(moment: str) -> dict[str, str]:
    return {
        "year": f"CAST(year({moment}) AS INTEGER)",
        "month": f"coalesce(strftime({moment}, '%m'), 'null')",
        "day": f"coalesce(strftime({moment}, '%d'), 'null')",
    }


TIER3 = """CASE WHEN {t} IS NULL AND user_id IS NULL THEN 'anon' WHEN {t} IS NULL AND user_id IS NOT NULL THEN 'free'
 WHEN lower({t}) = 'free' AND user_id IS NULL THEN 'anon' ELSE lower({t}) END"""
TIER5 = """CASE WHEN user_tier IS NULL AND user_key IS NULL THEN 'anon' WHEN user_tier IS NULL THEN 'free'
 WHEN lower(user_tier) = 'first' THEN 'premium' WHEN lower(user_tier) = 'free' AND user_key IS NULL THEN 'anon'
 ELSE lower(user_tier) END"""
NOT_BOT = """(context_user_agent IS NULL OR NOT (regexp_matches(context_user_agent, 'bot')
 OR regexp_matches(context_user_agent, 'spider') OR regexp_matches(context_user_agent, 'crawl')))"""
BREAK = """CASE break_type WHEN 'preroll' THEN 'pre-roll' WHEN 'PREROLL' THEN 'pre-roll'
 WHEN 'midroll' THEN 'mid-roll' WHEN 'MIDROLL' THEN 'mid-roll' ELSE break_type END"""
TARGET = """CASE WHEN target_type = 'show' OR target_type = 'shows' THEN 'series'
 WHEN target_type = 'episode' OR target_type = 'epısode' THEN 'episodes' ELSE target_type END"""
ASCII = "CASE WHEN title = '' THEN NULL ELSE regexp_replace(title, '[^\\x00-\\x7F]', '', 'g') END"
PERCENT = """CAST(round(round(CAST(percentage_watched AS FLOAT), 4) * CAST(100 AS FLOAT), 0) AS INTEGER)"""
DECILE = f"""CASE WHEN {PERCENT} // 10 BETWEEN 1 AND 10
 THEN CAST(pow(10, {PERCENT} // 10 - 1) AS INTEGER) ELSE 0 END"""
WHOLE = """TRY_CAST(regexp_extract(amount_cents, '^[+-]?[0-9]+') AS INTEGER)"""

# Output columns of the event jobs: "name" keeps a raw column, "name=expression" computes one.
# Entries are separated by semicolons; t3 stands for the tier rule on user_tier.
AT = "event_timestamp=received_at"
RSS = f"event_id=id; anonymous_id; user_id; user_tier=t3; series_id=series_uuid; {AT}; platform=pf"
RSS_NO_TIER = f"event_id=id; anonymous_id; user_id; series_id=series_uuid; {AT}; platform=pf"
GATE = f"message_id=id; anonymous_id; {AT}; episode_title; episode_uuid; platform; option_selected; on_mobile_device"
COMMUNITY = f"message_id=id; anonymous_id; user_id; {AT}; option_selected; platform=pf"
CHAT = f"message_id=id; user_id; {AT}; stream_title; option_selected; platform"
HERO = "event_id=id; user_id; anonymous_id; platform=pf; option_selected; hero_item_name; " + AT
HERO_EVENT = (
    "event_id=id; user_id; anonymous_id; user_tier=t3; item_type; item_name; item_use; url; cta_type; has_sso;"
    f" has_video; platform=pf; {AT}"
)
BLOCK = "message_id=id; anonymous_id; user_id; user_tier; content_block_display_type; "

MAPPED = {
    "ad_event": "ad_event_id=id; anonymous_id; break_type=BREAK; content_id; content_type; event_type=label; platform; "
    f"playhead_time=TRY_CAST(playhead_time AS DOUBLE); {AT}; on_mobile_device; user_id; user_tier=t3",
    "application_opened": "event_id=id; app_version=context_app_version; build=CAST(build AS VARCHAR); "
    "device_manufacturer=context_device_manufacturer; device_model=context_device_model; wifi=context_network_wifi; "
    "cellular=context_network_cellular; os_name=context_os_name; os_version=context_os_version; from_background; "
    f"{AT}; platform=CASE pf WHEN 'android' THEN 'Android' ELSE 'iOS' END; user_id; anonymous_id; "
    "user_tier=context_traits_member_tier",
    "cancel_save_accepted": f"event_id=id; {AT}; user_id; coupon_code; offer_code; new_plan_code; new_plan_end; "
    "new_plan_start; old_plan_code; old_plan_end; old_plan_start",
    "chat_event": f"chat_event_id=id; actor; action; target; room_id; anonymous_id; user_id; {AT}",
    "chat_login_complete": CHAT,
    "chat_shopping_event": f"event_id=id; {AT}; user_id; user_tier; product_title=name; product_id=shopify_id",
    "chat_signup_complete": CHAT,
    "chat_signup_event": f"message_id=id; anonymous_id; {AT}; stream_title; option_selected; platform",
    "click_event": f"event_id=id; user_id; anonymous_id; {AT}; label=left(label, 256); platform; "
    "context=left(context, 256); on_mobile_device",
    "community_login_complete": COMMUNITY,
    "community_signup_complete": COMMUNITY,
    "community_signup_event": f"message_id=id; anonymous_id; {AT}; option_selected; platform=pf",
    "content_block_carousel_item_clicked": BLOCK + "content_block_uuid; location; item_uuid; item_type; "
    f"carousel_item_index; carousel_per_page; carousel_item_page; {AT}; platform=pf",
    "content_block_item_clicked": BLOCK + "content_block_item_use_type; content_block_uuid; location; item_uuid; "
    f"item_type; {AT}; platform=pf",
    "content_block_link_clicked": BLOCK + f"content_block_item_use_type; content_block_uuid; location; target_url; {AT}; "
    "platform=pf; static_spotlight_element_clicked; static_spotlight_element_copy",
    "content_block_view_all_clicked": BLOCK + f"content_block_uuid; location; link_to=left(link_to, 512); {AT}; platform=pf",
    "discord_link_clicked": f"event_id=id; user_id; user_tier=m3; anonymous_id; {AT}; platform=pf",
    "experiment_viewed": f"event_id=id; anonymous_id; user_id; user_tier=t3; experiment_id; variation_id; {AT}; platform=pf",
    "feed_item_viewed": "id; user_id; anonymous_id; page; carousel_name; item_type; item_name; item_uuid; feed_tier; "
    "received_at; sent_at; original_timestamp",
    "fullscreen_event": f"event_id=id; user_id; user_tier=t3; anonymous_id; episode_key=content_id; {AT}; platform=pf; "
    "on_mobile_device",
    "gate_login_complete": GATE.replace("anonymous_id", "user_id; anonymous_id"),
    "gate_signup_complete": GATE.replace("anonymous_id", "user_id; anonymous_id"),
    "gate_signup_event": GATE,
    "growthbook_test_hero_event": HERO_EVENT,
    "heart_button_clicked": f"message_id=id; anonymous_id; user_id; user_tier; {AT}; platform=pf",
    "hero_event": HERO_EVENT + "; on_mobile_device",
    "hero_impression": "event_id=id; location=context_page_path; anonymous_id; user_id; user_tier=t3; item_type; item_use; "
    f"on_mobile_device; {AT}; platform",
    "hero_item_clicked": "message_id=id; timestamp=received_at; user_id; anonymous_id; event_location=location; "
    "event_type=label; item_name=target_name; item_id=target_uuid; platform",
    "hero_login_complete": HERO,
    "hero_signup_complete": HERO,
    "hero_signup_event": HERO,
    "initial_app_launch": f"anonymous_id; message_id=id; platform=pf; {AT}",
    "marketing_top_banner": f"anonymous_id; link; message_id=id; platform; {AT}; user_id; on_mobile_device; user_tier=t3",
    "my_hub_dismissed": f"message_id=id; anonymous_id; user_id; user_tier; source; loading; {AT}; platform=pf",
    "my_hub_opened": f"message_id=id; anonymous_id; user_id; user_tier; source; {AT}; platform=pf",
    "new_account_created": f"event_id=id; anonymous_id; user_id; platform=signup_source; {AT}",
    "page_event": "page_event_id=id; anonymous_id; user_id; user_tier=t3; path=left(path, 500); "
    f"previous_path=left(previous_url, 500); title=left(ASCII, 215); {AT}; on_mobile_device",
    "random_episode_viewed": "event_id=id; timestamp=received_at; user_id; anonymous_id; episode_key=item_id",
    "registration_succeeded": 'event_id=id; platform; anonymous_id; user_id; event_timestamp="timestamp"',
    "search_event": "message_id=id; event_type=left(label, 64); search_term=left(query_used, 256); target_id=target; "
    "target_type=left(TARGET, 32); user_id; anonymous_id; user_tier=t3; platform=pf; timestamp=received_at; selected_tab",
    "series_rss_button_clicked": RSS,
    "series_rss_login_successful": RSS,
    "series_rss_signup_successful": RSS_NO_TIER,
    "series_rss_trial_clicked": RSS,
    "series_rss_trial_successful": RSS_NO_TIER,
    "show_page_show_clicked": "event_id=id; anonymous_id; user_id; user_tier=t3; series_id=show_id; sort; "
    f"filter_channel_id; filter_genre; on_mobile_device; {AT}",
    "signup_button_clicked": "event_id=id; anonymous_id; context_page_url=left(context_page_url, 500); location; "
    f"{AT}; platform=pf; on_mobile_device",
    "signup_flow_event": f"event_id=id; user_id; user_tier; anonymous_id; {AT}; state; step; option_selected; platform=pf; "
    "on_mobile_device; campaign; code_applied",
    "smart_app_banner_button_click": f"event_id=id; user_id; anonymous_id; user_tier=t3; device; platform=pf; {AT}",
    "social_event": "message_id=id; user_id; anonymous_id; timestamp=received_at; event_type=label; target_type; target_id; "
    "platform",
    "trial_modal_shown": "message_id=id; user_id; anonymous_id; item_id; item_type; timestamp=received_at",
    "video_event": "video_event_id=id; session_id; user_id; user_tier=t3; anonymous_id; episode_key=content_id; label; "
    f"position; resolution; volume; full_screen; {AT}; platform=pf; on_mobile_device",
}
PLATFORMS = {
    "ad_event": THREE, "application_opened": ("android", "ios"), "cancel_save_accepted": ("backend",),
    "chat_event": ("chat_js",), "growthbook_test_hero_event": ("web_staging",), "initial_app_launch": TVS,
    "registration_succeeded": ("backend",), "search_event": THREE, "signup_button_clicked": THREE,
    "video_event": THREE,
}
LONGHAND = {
    "t3": TIER3.format(t="user_tier"), "m3": TIER3.format(t="member_tier"), "BREAK": BREAK,
    "left(TARGET, 32)": f"left({TARGET}, 32)", "left(ASCII, 215)": f"left({ASCII}, 215)",
}


def output_columns(text: str) -> dict[str, str]:
    columns = {}
    for entry in text.split(";"):
        name, _, expression = entry.strip().partition("=")
        columns[name] = LONGHAND.get(expression, expression or name)
    return columns


def first_rows(source: str, keys: list[str], order: list[str]) -> str:
    """The first row per key of a subquery; DuckDB's QUALIFY, with the order spelled out."""
    ordered = ", ".join(f'"{name}" NULLS LAST' for name in order)
    partition = ", ".join(f'"{name}"' for name in keys)
    return f"SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {partition} ORDER BY {ordered}) = 1"


def mapped(name: str, source: str | None = None, where: str = "TRUE", day_key: bool = False, text: str | None = None) -> str:
    """An event job: project, keep the first row per message and platform."""
    columns = output_columns(text or MAPPED[name])
    key = next(column for column, expression in columns.items() if expression == "id")
    time = next(column for column, expression in columns.items() if expression in ("received_at", '"timestamp"'))
    rest = [column for column in columns if column not in (key, time)] + ["year", "month", "day"]
    columns |= date_parts('"timestamp"' if name == "registration_succeeded" else "received_at")
    source = source or events(PLATFORMS.get(name, ("web",)), titles=name == "page_event")
    inner = f"(SELECT {listed(columns)}, pf AS _pf FROM {source} r WHERE {where})"
    keys = [key, "_pf"] + (["year", "month", "day"] if day_key else [])
    return f"SELECT * EXCLUDE (_pf) FROM ({first_rows(inner, keys, [time, *rest])})"


def playlist() -> str:
    item = {"viewed": "NULL::VARCHAR", "watched": "item_id", "added": "item_id"}
    kind = {"viewed": "NULL::VARCHAR", "watched": "item_type", "added": "item_type"}
    label = {"viewed": "Playlist Viewed", "watched": "Playlist Item Watched", "added": "Playlist Item Added"}
    parts = []
    for step in label:
        kept = "NULL::VARCHAR" if step == "added" else "{}"
        parts.append(
            mapped(
                "playlist_event",
                text=f"anonymous_id; item_id={item[step]}; item_type={kind[step]}; label='{label[step]}'; message_id=id; "
                f"platform; playlist_id={kept.format('playlist_id')}; playlist_name={kept.format('playlist_name')}; "
                "timestamp=received_at; user_id",
            )
        )
    return " UNION ALL ".join(f"({part})" for part in parts)


# Sessions: statistics per session joined to its distinct combinations, one combination kept.


def session_user(context: str, source: str) -> str:
    return f"""(SELECT DISTINCT pf, session_id, content_id, anonymous_id,
 CASE WHEN pf IN ('ios', 'android') THEN user_id ELSE user_uuid END AS uid, user_tier, {context} FROM {source} h)"""


def statistics(source: str, place: str = 'max("position")') -> str:
    return f"""(SELECT pf, session_id, count(*) AS beats, min(received_at) AS start_timestamp,
 max(received_at) AS end_timestamp, {place} AS max_position FROM {source} h GROUP BY pf, session_id)"""


def survivors(context: list[str], source: str, place: str = 'max("position")') -> str:
    kept = first_rows(
        session_user(", ".join(context), source),
        ["pf", "session_id"],
        ["content_id", "anonymous_id", "uid", "user_tier", *context],
    )
    return f"""(SELECT k.*, beats, start_timestamp, end_timestamp, max_position FROM ({kept}) k
 JOIN {statistics(source, place)} s ON k.pf = s.pf AND k.session_id = s.session_id)"""


def sessions(context: list[str], context_output: str, source: str | None = None, place: str = 'max("position")') -> str:
    source = source or heartbeats(ALL)
    return f"""SELECT session_id || year(start_timestamp) || strftime(start_timestamp, '%m')
 || strftime(start_timestamp, '%d') AS session_id, user_key, {TIER5} AS user_tier, anonymous_id,
 content_id AS episode_key, beats * 30 AS active_seconds, start_timestamp, end_timestamp,
 CAST(epoch(date_trunc('second', end_timestamp)) - epoch(date_trunc('second', start_timestamp)) AS BIGINT) + 30
 AS duration_seconds, max_position, pf AS platform, {context_output}, {listed(date_parts("start_timestamp"))}
FROM {survivors(context, source, place)} v LEFT JOIN {users()} u ON v.uid = u.user_id
WHERE content_id IS NOT NULL"""


def sessions_mixed_types() -> str:
    """The half of the month is part of the session while it is grouped; web positions compare as text."""
    halved = f"""(SELECT * REPLACE (session_id || CASE WHEN day(received_at) <= 15 THEN '~1' ELSE '~2' END AS session_id)
 FROM {heartbeats(ALL)} b)"""
    place = """CASE WHEN pf = 'web' THEN CAST(max(CAST("position" AS VARCHAR)) AS BIGINT) ELSE max("position") END"""
    found = sessions(["on_mobile_device"], "on_mobile_device", halved, place)
    return f"SELECT * REPLACE (regexp_replace(session_id, '~[12]', '') AS session_id) FROM ({found})"


def deciles(hb: str | None = None) -> str:
    hb = hb or heartbeats(("web",))
    return f"""WITH hb AS {hb}, joined AS (
 SELECT hb.session_id, user_key, {TIER5.replace("user_tier", "hb.user_tier")} AS user_tier, anonymous_id,
 content_id AS episode_key, start_timestamp, 'web' AS platform, on_mobile_device, {DECILE} AS decile,
 {listed(date_parts("start_timestamp"))}
 FROM hb LEFT JOIN (SELECT session_id, min(received_at) AS start_timestamp FROM hb GROUP BY session_id) s
 ON hb.session_id = s.session_id LEFT JOIN {users()} u ON hb.user_uuid = u.user_id
 WHERE hb.session_id IS NOT NULL AND content_id IS NOT NULL)
SELECT * EXCLUDE (decile), CAST(sum(DISTINCT decile) AS BIGINT) AS decile FROM joined GROUP BY ALL"""


def concurrents(dense: bool = True, source: str | None = None) -> str:
    return f"""SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') || pf AS session_id, bucket AS start_timestamp,
 CAST(n // 2 AS INTEGER) AS "count", pf AS platform, {listed(date_parts("bucket"))}
FROM (SELECT pf, time_bucket(INTERVAL 1 MINUTE, received_at) AS bucket, count(received_at) AS n
 FROM {source or heartbeats(SEVEN, dense=dense)} h GROUP BY 1, 2)"""


def visits() -> str:
    inner = f"""(SELECT id AS message_id, anonymous_id, received_at AS "timestamp", pf AS platform, user_id AS uid
 FROM {events(ALL)} r WHERE {NOT_BOT})"""
    kept = first_rows(inner, ["message_id", "platform"], ["timestamp", "anonymous_id", "uid"])
    return f"""SELECT message_id, anonymous_id, "timestamp", platform, user_key, {listed(date_parts('"timestamp"'))}
FROM ({kept}) v LEFT JOIN {users()} u ON v.uid = u.user_id
WHERE message_id IS NOT NULL AND anonymous_id IS NOT NULL"""


EVENT_TIME = "coalesce(TRY_CAST(original_timestamp AS TIMESTAMP), CAST(received_at AS TIMESTAMP))"


def subscription() -> str:
    columns = {
        "id": "id",
        "subscription_id": "subscription_id",
        "subscription_event": "_event",
        "subscription_event_type": "event_type",
        "start_timestamp": "TRY_CAST(start_timestamp AS TIMESTAMP)",
        "end_timestamp": "TRY_CAST(end_timestamp AS TIMESTAMP)",
        "event_timestamp": EVENT_TIME,
        "trial": "TRY_CAST(trial AS BOOLEAN)",
        "payment_provider": "payment_provider",
        "membership_plan": "membership_plan",
        "amount_cents": WHOLE,
        "coupon_code": "coupon_code",
        "stripe_user": "TRY_CAST(stripe_user AS BOOLEAN)",
        "sent_at": "TRY_CAST(sent_at AS TIMESTAMP)",
        "user_id": "user_id",
        **date_parts("received_at"),
    }
    keys = ["subscription_id", "subscription_event", "subscription_event_type"]
    rest = [name for name in columns if name not in (*keys, "event_timestamp")]
    kept = first_rows(f"(SELECT {listed(columns)} FROM {subscriptions()} s)", keys, ["event_timestamp", *rest])
    return f"""SELECT user_key, k.* FROM ({kept}) k LEFT JOIN {users()} u ON k.user_id = u.user_id
WHERE subscription_id IS NOT NULL AND subscription_event IS NOT NULL AND subscription_event_type IS NOT NULL"""


def live_heartbeats() -> str:
    return f"""SELECT id AS heartbeat_id, session_id, anonymous_id, user_id, user_uuid, user_tier,
 received_at AS event_timestamp, pf AS platform, {listed(date_parts("received_at"))} FROM {heartbeats(ALL)} h"""


def jobs() -> dict[str, str]:
    where = {"page_event": NOT_BOT}
    found = {name: mapped(name, where=where.get(name, "TRUE")) for name in MAPPED}
    found["ad_event"] = f"SELECT * FROM ({found['ad_event']}) WHERE content_id IS NOT NULL"
    return found | {
        "playlist_event": playlist(),
        "vod_sessions": sessions(["on_mobile_device"], "on_mobile_device"),
        "vod_sessions_by_context": sessions(
            ["context_ip", "context_locale", "context_page_referrer"],
            "context_ip, context_locale, left(context_page_referrer, 512) AS context_page_referrer",
        ),
        "vod_deciles": deciles(),
        "live_concurrents": concurrents(),
        "vod_concurrents": concurrents(),
        "livestream_heartbeat": live_heartbeats(),
        "fact_visits": visits(),
        "subscription": subscription(),
    }


# Operators

WEB_EVENTS = events(("web",))
MATCHED = f"""(SELECT id, received_at, e.user_id, user_tier, user_key FROM {WEB_EVENTS} e
 LEFT JOIN {users()} u ON e.user_id = u.user_id)"""


def by_input_day(source: str) -> str:
    """Heartbeats whose sessions are one day's, as the day is part of a session while it is grouped."""
    return f"(SELECT * REPLACE (session_id || '~' || day(received_at) || '~' AS session_id) FROM {source} b)"


def whole_id(query: str) -> str:
    return f"SELECT * REPLACE (regexp_replace(session_id, '~[0-9]+~', '') AS session_id) FROM ({query})"


def lakes() -> dict[str, str]:
    """Runs over lakes that hold several feeds."""
    video = f"""(SELECT * FROM {heartbeats(ALL)} v WHERE "position" % 3 <> 0)"""
    live = f"""(SELECT * FROM {heartbeats(ALL)} v WHERE "position" % 3 = 0 AND pf <> 'lr_android')"""
    loaded = """CASE WHEN "position" % 7 = 0 THEN least(CAST(received_at AS DATE) + 1, DATE '2024-01-31')
 ELSE CAST(received_at AS DATE) END"""
    clicks = output_columns(MAPPED["signup_button_clicked"])
    rest = [name for name in clicks if name not in ("event_id", "event_timestamp")]
    clicked = f"""(SELECT {listed(clicks | date_parts("received_at"))}, pf AS _pf, strftime({loaded}, '%Y-%m-%d') AS input_day
 FROM (SELECT * REPLACE (CASE WHEN "position" % 11 <> 0 THEN id END AS id) FROM {events(THREE)} e) r)"""
    tier = """CASE WHEN day(received_at) <= 15 THEN CAST("position" % 5 AS VARCHAR) ELSE user_tier END"""
    beats = f"""(SELECT id AS heartbeat_id, session_id, anonymous_id, user_id, user_uuid, {tier} AS user_tier,
 received_at AS event_timestamp, pf AS platform FROM {heartbeats(("web", "ios"))} h)"""
    order = ["event_timestamp", "session_id", "anonymous_id", "user_id", "user_uuid", "user_tier", "platform"]
    seen = f"""(SELECT id AS message_id, anonymous_id, received_at AS "timestamp", pf AS platform, user_id AS uid,
 day(received_at) AS d FROM {events(ALL)} r WHERE {NOT_BOT} AND build % 2 = 0)"""
    kept = first_rows(seen, ["message_id", "platform", "d"], ["timestamp", "anonymous_id", "uid"])
    early = "(SELECT * FROM {} x WHERE day(event_timestamp) <= 15)"
    return {
        "rerun_days": "SELECT * EXCLUDE (_pf) FROM ("
        + first_rows(clicked, ["event_id", "_pf", "input_day"], ["event_timestamp", *rest, "year", "month", "day"]) + ")",
        "publish_type_drift": merged(
            first_rows(beats, ["heartbeat_id"], order), "heartbeat_id",
            first_rows(early.format(beats), ["heartbeat_id"], order),
        ),
        "visits_from_lake": f"""SELECT message_id, anonymous_id, "timestamp", platform, user_key,
 {listed(date_parts('"timestamp"'))} FROM ({kept}) v LEFT JOIN {users()} u ON v.uid = u.user_id
WHERE message_id IS NOT NULL AND anonymous_id IS NOT NULL""",
        "sessions_backfill": whole_id(sessions(["on_mobile_device"], "on_mobile_device", by_input_day(video))),
        "deciles_backfill": whole_id(deciles(by_input_day(f"(SELECT * FROM {video} w WHERE pf = 'web')"))),
        "live_concurrents_from_lake": f"SELECT * EXCLUDE (year, month, day) FROM ({concurrents(source=live)})",
        "vod_concurrents_from_lake": f"""SELECT * EXCLUDE (year, month, day)
FROM ({concurrents(source=f"(SELECT * FROM {video} v WHERE pf <> 'lr_android')")})""",
    }


def run_date_places(days: str) -> str:
    return f"""SELECT strftime(received_at, '%Y-%m-%d') AS run_date, place, count(*) AS events
FROM {WEB_EVENTS} e LEFT JOIN (VALUES {days}) d(day, place) ON strftime(received_at, '%Y-%m-%d') = day GROUP BY 1, 2"""


def lake_events() -> str:
    """The lake's rows: ios files of even days lack the flag and get the default."""
    flagless = "pf = 'ios' AND day(received_at) % 2 = 0"
    return f"""(SELECT * REPLACE (CASE WHEN {flagless} THEN TRUE ELSE on_mobile_device END AS on_mobile_device)
 FROM {events(THREE)} r)"""


def merged(stage: str, key: str, first_half: str) -> str:
    """Rows of the first half first, then the earliest of every key not among them."""
    return f"""WITH early AS ({first_half}), everything AS ({stage})
SELECT * FROM early UNION ALL SELECT * FROM everything e WHERE NOT EXISTS (SELECT 1 FROM early x WHERE x.{key} = e.{key})"""


def operators() -> dict[str, str]:
    all_jobs = jobs()
    hb_all, hb_web = heartbeats(ALL), heartbeats(("web",))
    described = ["content_id", "anonymous_id", "uid", "user_tier", "on_mobile_device"]
    stats = statistics(hb_all)
    lake = lake_events()
    two_halves = "SELECT id, received_at, user_tier, label FROM " + WEB_EVENTS + " e"
    subs = subscriptions()
    click = "SELECT event_id, event_timestamp, platform, year, month, day FROM (" + all_jobs["click_event"] + ")"
    lake_days = mapped("signup_button_clicked", source=lake, day_key=True)
    lake_columns = "* EXCLUDE (year, month, day)"

    def first_of(rows: str, order: list[str], where: str = "TRUE") -> str:
        return first_rows(f"(SELECT * FROM ({rows}) WHERE {where})", ["id"], order)

    def published(where: str) -> str:
        return first_rows(
            f"(SELECT {lake_columns} FROM ({lake_days}) WHERE {where})",
            ["event_id"],
            ["event_timestamp", "anonymous_id", "context_page_url", "location", "platform", "on_mobile_device"],
        )

    ungrouped = ("heart_button_clicked", "new_account_created", "video_event")
    counts = {
        "sandbox_vod_sessions" if name == "vod_sessions_by_context" else name: query
        for name, query in all_jobs.items()
        if name not in ungrouped
    }
    return {
        "scan_event_day": f"""SELECT id, received_at, strftime(received_at, '%Y-%m-%d') AS run_date, pf AS platform
 FROM {lake} r""",
        "scan_by_platform": f"SELECT pf AS platform, on_mobile_device, count(*) AS events FROM {lake} r GROUP BY 1, 2",
        "missing_platform_ok": f"""SELECT pf AS platform, strftime(received_at, '%Y-%m-%d') AS run_date,
 count(*) AS events FROM {lake} r GROUP BY 1, 2""",
        "scan_dim_user": f"SELECT user_key, user_id FROM {users()} u",
        "export_dim_user": f"SELECT user_key, user_id FROM {users()} u",
        "sink_roundtrip": all_jobs["click_event"],
        "sink_dynamic_overwrite": f"""SELECT * REPLACE (CASE WHEN CAST(day AS INTEGER) >= 16
 THEN platform || ' again' ELSE platform END AS platform) FROM ({click})""",
        "stage_load": f"SELECT * EXCLUDE (year, month, day) FROM ({all_jobs['click_event']})",
        "stage_replace": f"SELECT label, count(*) AS events FROM {WEB_EVENTS} e GROUP BY label",
        "run_dates_range": run_date_places(", ".join(f"('2024-01-{31 - at:02d}', {at})" for at in range(1, 31))),
        "run_dates_list": run_date_places("('2024-01-12', 1), ('2024-01-03', 2), ('2024-01-27', 3)"),
        "backfill_dates": lake_days,
        "publish_event": merged(
            published("TRUE"), "event_id", published("CAST(day AS INTEGER) >= 16")
        ),
        "group_row_counts": " UNION ALL ".join(
            f"SELECT '{name}' AS job, count(*) AS rows FROM ({query})" for name, query in counts.items()
        ),
        "default_missing_columns": mapped(
            "search_event",
            source=f"""(SELECT * REPLACE (CASE WHEN pf <> 'web' THEN selected_tab END AS selected_tab,
 CASE WHEN pf = 'web' THEN user_tier END AS user_tier, CASE WHEN pf = 'web' THEN user_id END AS user_id)
 FROM {events(THREE)} r)""",
        ),
        "default_false_flags": mapped(
            "hero_event",
            source=f"""(SELECT * REPLACE (CASE WHEN day(received_at) <= 15 THEN FALSE ELSE has_sso END AS has_sso,
 CASE WHEN day(received_at) <= 15 THEN FALSE ELSE has_video END AS has_video) FROM {WEB_EVENTS} r)""",
        ),
        "default_platform": mapped(
            "hero_impression",
            source=f"""(SELECT * REPLACE (CASE WHEN day(received_at) <= 15 THEN 'web' ELSE platform END AS platform)
 FROM {WEB_EVENTS} r)""",
        ),
        "sessions_mixed_types": sessions_mixed_types(),
        "concurrents_backfill": concurrents(dense=False),
        "scan_type_drift": f"""SELECT id, received_at, strftime(received_at, '%Y-%m-%d') AS run_date,
 CAST("position" AS VARCHAR) AS "position" FROM {WEB_EVENTS} e""",
        "merge_bucketed": merged(
            first_of(two_halves, ["received_at", "user_tier", "label"]),
            "id",
            first_of(two_halves, ["received_at", "user_tier", "label"], "day(received_at) <= 15"),
        ),
        "default_mobile_flag": mapped(
            "signup_button_clicked",
            source=f"""(SELECT * REPLACE (CASE pf WHEN 'ios' THEN TRUE WHEN 'android' THEN on_mobile_device END
 AS on_mobile_device) FROM {events(THREE)} r)""",
        ),
        "default_mobile_flag_tv": f"""SELECT id, received_at, pf AS platform,
 CASE WHEN pf IN ('ios', 'android') THEN TRUE WHEN pf LIKE 'lr\\_%' ESCAPE '\\' THEN FALSE END AS on_mobile_device
 FROM {hb_all} h""",
        "filter_bots": f"SELECT id, received_at, context_user_agent FROM {WEB_EVENTS} e WHERE {NOT_BOT}",
        "drop_null_keys": f"""SELECT id, received_at, session_id, content_id FROM {hb_web} h
 WHERE session_id IS NOT NULL AND content_id IS NOT NULL""",
        "coalesce_event_time": f"SELECT id, {EVENT_TIME} AS event_timestamp FROM {subs} s",
        "pick_user_column": f"""SELECT id, received_at,
 CASE WHEN pf IN ('android', 'ios') THEN user_id WHEN pf = 'web' THEN user_uuid END AS visit_user,
 CASE WHEN pf IN ('android', 'ios') THEN user_id WHEN pf = 'web' THEN user_uuid END AS session_user
 FROM {events(ALL)} e""",
        "normalize_break_type": f"""SELECT break_type AS raw_type, {BREAK} AS break_type, count(*) AS events
 FROM {WEB_EVENTS} e GROUP BY ALL""",
        "normalize_target_type": f"""SELECT target_type AS raw_type, {TARGET} AS target_type, count(*) AS events
 FROM {WEB_EVENTS} e GROUP BY ALL""",
        "user_tier_event": f"""SELECT user_tier AS raw_tier, user_id IS NOT NULL AS signed_in,
 {LONGHAND['t3']} AS user_tier, count(*) AS events FROM {WEB_EVENTS} e GROUP BY ALL""",
        "user_tier_session": f"""SELECT user_tier AS raw_tier, user_key IS NOT NULL AS matched, {TIER5} AS user_tier,
 count(*) AS events FROM {MATCHED} m GROUP BY ALL""",
        "join_dim_user_left": f"SELECT id, received_at, user_id, user_key FROM {MATCHED} m",
        "decile_weight": f"""SELECT percentage_watched, {DECILE} AS decile, count(*) AS beats
 FROM {hb_web} h GROUP BY ALL""",
        "decile_bitmap": f"""SELECT session_id, CAST(sum(DISTINCT {DECILE}) AS BIGINT) AS decile FROM {hb_web} h
 WHERE session_id IS NOT NULL GROUP BY session_id""",
        "minute_counts": f"""SELECT pf AS platform, time_bucket(INTERVAL 1 MINUTE, received_at) AS start_timestamp,
 count(received_at) AS beats FROM {hb_all} h GROUP BY 1, 2""",
        "session_combinations": f"""SELECT pf AS platform, session_id, content_id, anonymous_id,
 CASE WHEN pf IN ('ios', 'android') THEN user_id ELSE user_uuid END AS user_id, user_tier, on_mobile_device,
 count(*) AS "count" FROM {hb_all} h WHERE session_id IS NOT NULL GROUP BY ALL""",
        "session_stats_join": f"""SELECT pf AS platform, session_id, CAST(beats AS BIGINT) AS beats, start_timestamp,
 end_timestamp, max_position, content_id, anonymous_id, uid AS user_id, user_tier, on_mobile_device
 FROM {survivors(described[4:], hb_all)} v""",
        "session_heartbeat_count": f"SELECT pf AS platform, session_id, beats FROM {stats} s WHERE session_id IS NOT NULL",
        "session_start": f"SELECT pf AS platform, session_id, start_timestamp FROM {stats} s WHERE session_id IS NOT NULL",
        "session_end": f"SELECT pf AS platform, session_id, end_timestamp FROM {stats} s WHERE session_id IS NOT NULL",
        "session_max_position": f"SELECT pf AS platform, session_id, max_position FROM {stats} s WHERE session_id IS NOT NULL",
        "dedup_message_id": first_rows(
            f"(SELECT id, pf AS platform, received_at, anonymous_id, user_tier, position FROM {events(ALL)} e)",
            ["id", "platform"],
            ["received_at", "anonymous_id", "user_tier", "position"],
        ),
        "dedup_subscription": first_rows(
            f"(SELECT subscription_id, _event, event_type, received_at, id FROM {subs} s)",
            ["subscription_id", "_event", "event_type"],
            ["received_at", "id"],
        ),
        "dedup_earliest": first_rows(
            f"(SELECT anonymous_id, original_timestamp, id FROM {WEB_EVENTS} e)",
            ["anonymous_id"],
            ["original_timestamp", "id"],
        ),
        "union_platforms": f"""SELECT id, received_at, pf AS platform, CAST("position" AS VARCHAR) AS "position"
 FROM {events(('web', 'ios', 'android'))} e""",
        "scalar_date_parts": f"SELECT id, received_at, {listed(date_parts('original_timestamp'))} FROM {WEB_EVENTS} e",
        "scalar_truncate": f"""SELECT id, received_at, left(path, 500) AS path, left(label, 64) AS label,
 left(query_used, 256) AS query_used, left(context, 256) AS context, left(link_to, 512) AS link_to
 FROM {WEB_EVENTS} e""",
        "scalar_casts": f"""SELECT id, {WHOLE} AS amount_cents, TRY_CAST(trial AS BOOLEAN) AS trial,
 TRY_CAST(stripe_user AS BOOLEAN) AS stripe_user, TRY_CAST(end_timestamp AS TIMESTAMP) AS end_timestamp,
 TRY_CAST(amount_cents AS DOUBLE) AS amount FROM {subs} s""",
        "ascii_title": f"SELECT id, received_at, {ASCII} AS title FROM {events(('web',), titles=True)} e",
        "merge_insert_absent": merged(
            first_of(two_halves, ["received_at", "user_tier", "label"]),
            "id",
            first_of(two_halves, ["received_at", "user_tier", "label"], "day(received_at) <= 15"),
        ),
        "merge_with_dupes": f"SELECT * EXCLUDE (year, month, day) FROM ({all_jobs['vod_deciles']})",
    }


def oracle_sql() -> dict[str, str]:
    return jobs() | operators() | lakes()
