"""All jobs by name, and the groups that run together."""

from __future__ import annotations

from beatlake.plans.catalog import EVENT_JOBS
from beatlake.plans.concurrents import LIVE_CONCURRENTS, VOD_CONCURRENTS
from beatlake.plans.facts import FACT_VISITS, LIVESTREAM_HEARTBEAT, SUBSCRIPTION
from beatlake.plans.model import Job
from beatlake.plans.sessions import SANDBOX_VOD_SESSIONS, VOD_DECILES, VOD_SESSIONS

CORE_JOBS: tuple[Job, ...] = (
    FACT_VISITS,
    LIVE_CONCURRENTS,
    LIVESTREAM_HEARTBEAT,
    SUBSCRIPTION,
    VOD_CONCURRENTS,
    VOD_SESSIONS,
    VOD_DECILES,
    SANDBOX_VOD_SESSIONS,
)
JOBS: dict[str, Job] = {job.name: job for job in (*EVENT_JOBS, *CORE_JOBS)}

# Jobs whose merge keeps several rows per key, told apart by time.
DUPLICATE_KEY_JOBS = ("vod_deciles",)

# The jobs of each batch.
GROUPS: dict[str, tuple[str, ...]] = {
    "core": (
        "fact_visits", "live_concurrents", "livestream_heartbeat", "subscription", "vod_concurrents",
        "vod_sessions",
    ),
    "events_1": (
        "ad_event", "application_opened", "cancel_save_accepted", "chat_event", "chat_login_complete",
        "chat_shopping_event", "chat_signup_complete", "chat_signup_event", "click_event",
        "community_login_complete", "community_signup_complete", "community_signup_event",
        "content_block_item_clicked", "content_block_link_clicked", "content_block_carousel_item_clicked",
        "content_block_view_all_clicked", "discord_link_clicked", "feed_item_viewed", "gate_login_complete",
        "gate_signup_complete", "gate_signup_event", "hero_event", "hero_item_clicked", "hero_impression",
    ),
    "events_2": (
        "hero_login_complete", "hero_signup_event", "hero_signup_complete", "initial_app_launch",
        "marketing_top_banner", "my_hub_opened", "my_hub_dismissed", "page_event", "playlist_event",
        "random_episode_viewed", "registration_succeeded", "search_event", "series_rss_button_clicked",
        "series_rss_login_successful", "series_rss_trial_successful", "series_rss_trial_clicked",
        "series_rss_signup_successful", "show_page_show_clicked", "signup_button_clicked", "signup_flow_event",
        "smart_app_banner_button_click", "social_event", "trial_modal_shown", "fullscreen_event",
    ),
    "deciles": ("vod_deciles",),
    "experiment_viewed": ("experiment_viewed",),
    "experiments": ("experiment_viewed", "growthbook_test_hero_event"),
    "sandbox": ("sandbox_vod_sessions",),
    "gate_backfill": ("gate_login_complete", "gate_signup_complete", "gate_signup_event"),
    "onboarding_backfill": ("content_block_item_clicked", "content_block_link_clicked"),
    "community_backfill": ("community_login_complete", "community_signup_complete", "community_signup_event"),
}


def jobs_named(names: list[str]) -> list[Job]:
    """The jobs behind job and group names, each once, in the order first named."""
    expanded = [job for name in names for job in GROUPS.get(name, (name,))]
    unknown = sorted(set(expanded) - JOBS.keys())
    if unknown:
        raise ValueError(f"unknown jobs: {', '.join(unknown)}")
    return [JOBS[name] for name in dict.fromkeys(expanded)]
