"""The event jobs, as data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatlake.functions import rules
from beatlake.plans.events import EventJob, Part
from beatlake.plans.model import Feed, Rule, Source
from beatlake.sources.lake import PLATFORM

WEB = ("web",)
PHONES = ("android", "ios")
WEB_AND_PHONES = ("web", "android", "ios")
TVS = rules.TV_PLATFORMS
PROPER_NAMES = {"android": "Android", "ios": "iOS"}


def loaded_from() -> Column:
    """The platform the row was loaded for, whatever its own platform column says."""
    return F.col(PLATFORM)


def proper_platform() -> Column:
    return rules.renamed(F.col(PLATFORM), {proper: (plain,) for plain, proper in PROPER_NAMES.items()})


def tier(column: str = "user_tier") -> Rule:
    return Rule((column, "user_id"), lambda: rules.event_tier(F.col(column), F.col("user_id")))


def cut(column: str, length: int) -> Rule:
    return Rule((column,), lambda: rules.truncated(column, length))


def constant(text: str | None) -> Rule:
    return Rule((), lambda: F.lit(text).cast("string"))


def false() -> Column:
    return F.lit(False)


def columns(*entries: str | tuple[str, Source]) -> tuple[tuple[str, Source], ...]:
    """Output columns; a plain string is one or more raw columns kept under their names."""
    result: list[tuple[str, Source]] = []
    for entry in entries:
        if isinstance(entry, str):
            result += [(name, name) for name in entry.split()]
        else:
            result.append(entry)
    return tuple(result)


def event(
    name: str,
    key: str,
    *entries: str | tuple[str, Source],
    platforms: tuple[str, ...] = WEB,
    segment_type: str | None = None,
    nulls: str = "",
    defaults: Mapping[str, Callable[[], Column]] | None = None,
    mobile: bool = False,
    **options,
) -> EventJob:
    """A job that reads one feed, by default the web one of its own name."""
    feed = Feed(segment_type or name, platforms, tuple(nulls.split()), defaults or {}, mobile)
    return EventJob(name, key, (Part(feed, columns(*entries)),), **options)


AT = ("event_timestamp", "received_at")
HERE = ("platform", Rule((), loaded_from))
USER_TIER = ("user_tier", tier())
EVENT_ID = ("event_id", "id")
MESSAGE_ID = ("message_id", "id")

PLAYLIST = EventJob(
    "playlist_event",
    "message_id",
    (
        Part(
            Feed("playlist_viewed", WEB),
            columns(
                "anonymous_id", ("item_id", constant(None)), ("item_type", constant(None)),
                ("label", constant("Playlist Viewed")), MESSAGE_ID, "platform playlist_id playlist_name",
                ("timestamp", "received_at"), "user_id",
            ),
        ),
        Part(
            Feed("playlist_item_watched", WEB),
            columns(
                "anonymous_id item_id item_type", ("label", constant("Playlist Item Watched")), MESSAGE_ID,
                "platform playlist_id playlist_name", ("timestamp", "received_at"), "user_id",
            ),
        ),
        Part(
            Feed("playlist_item_added", WEB, ("item_id",)),
            columns(
                "anonymous_id item_id item_type", ("label", constant("Playlist Item Added")), MESSAGE_ID,
                "platform", ("playlist_id", constant(None)), ("playlist_name", constant(None)),
                ("timestamp", "received_at"), "user_id",
            ),
        ),
    ),
    sort_key="timestamp",
)

EVENT_JOBS = (
    event(
        "ad_event", "ad_event_id", ("ad_event_id", "id"), "anonymous_id",
        ("break_type", Rule(("break_type",), lambda: rules.renamed(F.col("break_type"), rules.BREAK_TYPES))),
        "content_id content_type", ("event_type", "label"), "platform",
        "playhead_time",
        AT, "on_mobile_device user_id", USER_TIER,
        platforms=WEB_AND_PHONES, nulls="playhead_time break_type user_id user_tier", mobile=True,
        drop_null_last=("content_id",),
    ),
    event(
        "application_opened", "event_id", EVENT_ID, ("app_version", "context_app_version"),
        "build",
        ("device_manufacturer", "context_device_manufacturer"), ("device_model", "context_device_model"),
        ("wifi", "context_network_wifi"), ("cellular", "context_network_cellular"),
        ("os_name", "context_os_name"), ("os_version", "context_os_version"), "from_background", AT,
        ("platform", Rule((), proper_platform)), "user_id anonymous_id", ("user_tier", "context_traits_member_tier"),
        platforms=PHONES, nulls="user_id",
    ),
    event(
        "cancel_save_accepted", "event_id", EVENT_ID, AT,
        "user_id coupon_code offer_code new_plan_code new_plan_end new_plan_start",
        "old_plan_code old_plan_end old_plan_start",
        platforms=("backend",),
    ),
    event(
        "chat_event", "chat_event_id", ("chat_event_id", "id"),
        "actor action target room_id anonymous_id user_id", AT,
        platforms=("chat_js",), nulls="user_id target room_id",
    ),
    event(
        "chat_login_complete", "message_id", MESSAGE_ID, "user_id", AT, "stream_title option_selected platform",
        nulls="user_id",
    ),
    event(
        "chat_shopping_event", "event_id", EVENT_ID, AT, "user_id user_tier",
        ("product_title", "name"), ("product_id", "shopify_id"),
        nulls="user_id",
    ),
    event("chat_signup_complete", "message_id", MESSAGE_ID, "user_id", AT, "stream_title option_selected platform"),
    event("chat_signup_event", "message_id", MESSAGE_ID, "anonymous_id", AT, "stream_title option_selected platform"),
    event(
        "click_event", "event_id", EVENT_ID, "user_id anonymous_id", AT, ("label", cut("label", 256)), "platform",
        ("context", cut("context", 256)), "on_mobile_device",
        nulls="user_id context", mobile=True,
    ),
    event(
        "community_login_complete", "message_id", MESSAGE_ID, "anonymous_id user_id", AT, "option_selected", HERE,
        nulls="option_selected",
    ),
    event(
        "community_signup_complete", "message_id", MESSAGE_ID, "anonymous_id user_id", AT, "option_selected", HERE,
        nulls="option_selected",
    ),
    event(
        "community_signup_event", "message_id", MESSAGE_ID, "anonymous_id", AT, "option_selected", HERE,
        nulls="option_selected",
    ),
    event(
        "content_block_carousel_item_clicked", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier",
        "content_block_display_type content_block_uuid location item_uuid item_type",
        "carousel_item_index carousel_per_page carousel_item_page", AT, HERE,
    ),
    event(
        "content_block_item_clicked", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier",
        "content_block_display_type content_block_item_use_type content_block_uuid location item_uuid item_type",
        AT, HERE,
        nulls="content_block_item_use_type",
    ),
    event(
        "content_block_link_clicked", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier",
        "content_block_display_type content_block_item_use_type content_block_uuid location target_url", AT, HERE,
        "static_spotlight_element_clicked static_spotlight_element_copy",
        nulls="user_id content_block_item_use_type static_spotlight_element_clicked static_spotlight_element_copy",
    ),
    event(
        "content_block_view_all_clicked", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier",
        "content_block_display_type content_block_uuid location", ("link_to", cut("link_to", 512)), AT, HERE,
        nulls="user_id link_to",
    ),
    event(
        "discord_link_clicked", "event_id", EVENT_ID, "user_id", ("user_tier", tier("member_tier")),
        "anonymous_id", AT, HERE,
        nulls="member_tier user_id",
    ),
    event(
        "experiment_viewed", "event_id", EVENT_ID, "anonymous_id user_id", USER_TIER, "experiment_id variation_id",
        AT, HERE,
        nulls="user_id user_tier",
    ),
    event(
        "feed_item_viewed", "id", "id user_id anonymous_id page carousel_name item_type item_name item_uuid",
        "feed_tier received_at sent_at original_timestamp",
        nulls="user_id", sort_key="received_at",
    ),
    event(
        "fullscreen_event", "event_id", EVENT_ID, "user_id", USER_TIER, "anonymous_id",
        ("episode_key", "content_id"), AT, HERE, "on_mobile_device",
        nulls="user_tier user_id", mobile=True,
    ),
    event(
        "gate_login_complete", "message_id", MESSAGE_ID, "user_id anonymous_id", AT,
        "episode_title episode_uuid platform option_selected on_mobile_device",
        mobile=True,
    ),
    event(
        "gate_signup_complete", "message_id", MESSAGE_ID, "user_id anonymous_id", AT,
        "episode_title episode_uuid platform option_selected on_mobile_device",
        mobile=True,
    ),
    event(
        "gate_signup_event", "message_id", MESSAGE_ID, "anonymous_id", AT,
        "episode_title episode_uuid platform option_selected on_mobile_device",
        mobile=True,
    ),
    event(
        "growthbook_test_hero_event", "event_id", EVENT_ID, "user_id anonymous_id", USER_TIER,
        "item_type item_name item_use url cta_type has_sso has_video", HERE, AT,
        platforms=("web_staging",), segment_type="hero_event",
        nulls="user_tier user_id item_use url has_sso has_video",
    ),
    event(
        "heart_button_clicked", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier", AT, HERE,
        nulls="user_id",
    ),
    event(
        "hero_event", "event_id", EVENT_ID, "user_id anonymous_id", USER_TIER,
        "item_type item_name item_use url cta_type has_sso has_video", HERE, AT, "on_mobile_device",
        nulls="user_tier user_id item_use url", defaults={"has_sso": false, "has_video": false}, mobile=True,
    ),
    event(
        "hero_impression", "event_id", EVENT_ID, ("location", "context_page_path"), "anonymous_id user_id",
        USER_TIER, "item_type item_use on_mobile_device", AT, "platform",
        nulls="item_use user_id user_tier", defaults={"platform": loaded_from}, mobile=True,
    ),
    event(
        "hero_item_clicked", "message_id", MESSAGE_ID, ("timestamp", "received_at"), "user_id anonymous_id",
        ("event_location", "location"), ("event_type", "label"), ("item_name", "target_name"),
        ("item_id", "target_uuid"), "platform",
        nulls="target_name target_uuid", sort_key="timestamp", drop_null_first=("timestamp",),
    ),
    event(
        "hero_login_complete", "event_id", EVENT_ID, "user_id anonymous_id", HERE, "option_selected hero_item_name",
        AT, nulls="user_id",
    ),
    event(
        "hero_signup_complete", "event_id", EVENT_ID, "user_id anonymous_id", HERE, "option_selected hero_item_name",
        AT, nulls="user_id",
    ),
    event(
        "hero_signup_event", "event_id", EVENT_ID, "user_id anonymous_id", HERE, "option_selected hero_item_name",
        AT, nulls="user_id",
    ),
    event(
        "initial_app_launch", "message_id", "anonymous_id", MESSAGE_ID, ("platform", Rule((), proper_platform)), AT,
        platforms=TVS,
    ),
    event(
        "marketing_top_banner", "message_id", "anonymous_id link", MESSAGE_ID, "platform", AT,
        "user_id on_mobile_device", USER_TIER,
        nulls="user_id user_tier", mobile=True,
    ),
    event(
        "my_hub_dismissed", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier source loading", AT, HERE,
    ),
    event("my_hub_opened", "message_id", MESSAGE_ID, "anonymous_id user_id user_tier source", AT, HERE),
    event(
        "new_account_created", "event_id", EVENT_ID, "anonymous_id user_id", ("platform", "signup_source"), AT,
    ),
    event(
        "page_event", "page_event_id", ("page_event_id", "id"), "anonymous_id user_id", USER_TIER,
        ("path", cut("path", 500)), ("previous_path", cut("previous_url", 500)),
        ("title", Rule(("title",), lambda: F.substring(rules.ascii_text(F.col("title")), 1, 215))), AT, "on_mobile_device",
        segment_type="pages", nulls="user_tier user_id context_user_agent", mobile=True, skip_bots=True,
    ),
    PLAYLIST,
    event(
        "random_episode_viewed", "event_id", EVENT_ID, ("timestamp", "received_at"), "user_id anonymous_id",
        ("episode_key", "item_id"),
        sort_key="timestamp",
    ),
    event(
        "registration_succeeded", "event_id", EVENT_ID, "platform anonymous_id user_id",
        ("event_timestamp", "timestamp"),
        platforms=("backend",), nulls="user_id",
    ),
    event(
        "search_event", "message_id", MESSAGE_ID, ("event_type", cut("label", 64)),
        ("search_term", cut("query_used", 256)), ("target_id", "target"),
        (
            "target_type",
            Rule(("target_type",), lambda: F.substring(rules.renamed(F.col("target_type"), rules.TARGET_TYPES), 1, 32)),
        ),
        "user_id anonymous_id", USER_TIER, HERE, ("timestamp", "received_at"), "selected_tab",
        platforms=WEB_AND_PHONES, nulls="user_tier user_id selected_tab", sort_key="timestamp",
    ),
    event(
        "series_rss_button_clicked", "event_id", EVENT_ID, "anonymous_id user_id", USER_TIER,
        ("series_id", "series_uuid"), AT, HERE,
        nulls="user_tier user_id series_uuid",
    ),
    event(
        "series_rss_login_successful", "event_id", EVENT_ID, "anonymous_id user_id", USER_TIER,
        ("series_id", "series_uuid"), AT, HERE,
        nulls="user_tier user_id series_uuid",
    ),
    event(
        "series_rss_signup_successful", "event_id", EVENT_ID, "anonymous_id user_id",
        ("series_id", "series_uuid"), AT, HERE,
        nulls="user_id series_uuid",
    ),
    event(
        "series_rss_trial_clicked", "event_id", EVENT_ID, "anonymous_id user_id", USER_TIER,
        ("series_id", "series_uuid"), AT, HERE,
        nulls="user_id user_tier series_uuid",
    ),
    event(
        "series_rss_trial_successful", "event_id", EVENT_ID, "anonymous_id user_id",
        ("series_id", "series_uuid"), AT, HERE,
        nulls="user_id series_uuid",
    ),
    event(
        "show_page_show_clicked", "event_id", EVENT_ID, "anonymous_id user_id", USER_TIER, ("series_id", "show_id"),
        "sort filter_channel_id filter_genre on_mobile_device", AT,
        nulls="user_tier user_id filter_channel_id filter_genre", mobile=True,
    ),
    event(
        "signup_button_clicked", "event_id", EVENT_ID, "anonymous_id",
        ("context_page_url", cut("context_page_url", 500)), "location", AT, HERE, "on_mobile_device",
        platforms=WEB_AND_PHONES, nulls="context_page_url", mobile=True,
    ),
    event(
        "signup_flow_event", "event_id", EVENT_ID, "user_id user_tier anonymous_id", AT,
        "state step option_selected", HERE, "on_mobile_device campaign code_applied",
        nulls="user_id option_selected campaign code_applied", mobile=True,
    ),
    event(
        "smart_app_banner_button_click", "event_id", EVENT_ID, "user_id anonymous_id", USER_TIER, "device", HERE, AT,
        nulls="user_tier user_id",
    ),
    event(
        "social_event", "message_id", MESSAGE_ID, "user_id anonymous_id", ("timestamp", "received_at"),
        ("event_type", "label"), "target_type target_id platform",
        sort_key="timestamp",
    ),
    event(
        "trial_modal_shown", "message_id", MESSAGE_ID, "user_id anonymous_id item_id item_type",
        ("timestamp", "received_at"),
        sort_key="timestamp",
    ),
    event(
        "video_event", "video_event_id", ("video_event_id", "id"), "session_id user_id", USER_TIER, "anonymous_id",
        ("episode_key", "content_id"), "label position resolution volume full_screen", AT, HERE, "on_mobile_device",
        platforms=WEB_AND_PHONES, nulls="user_tier user_id resolution", mobile=True,
    ),
)
