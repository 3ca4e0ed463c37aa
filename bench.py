"""Timed headline queries; prints one JSON line.

Each query is built and run to completion three times after a warm-up, and the best time counts.
"""

from __future__ import annotations

import json
import os
import time

from beatlake.session import build_session
from checks.queries import queries

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
HEADLINE = (
    "page_event", "click_event", "search_event", "video_event", "playlist_event", "vod_sessions",
    "vod_sessions_by_context", "vod_deciles", "live_concurrents", "vod_concurrents", "livestream_heartbeat",
    "fact_visits", "subscription", "dedup_message_id", "session_stats_join", "join_dim_user_left",
    "sink_roundtrip", "merge_insert_absent",
)


def seconds(run) -> float:
    started = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def best(run) -> float:
    return round(min(seconds(run) for _ in range(RUNS)), 3)


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds(lambda: registered["click_event"](spark, SF_DIR))
    times = {name: best(lambda name=name: registered[name](spark, SF_DIR)) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
