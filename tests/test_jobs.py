"""Job descriptions, sessions and facts on small frames, and runs over a small lake."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from beatlake.operators.merge import ParquetTarget, absent
from beatlake.plans.model import Feed, published_schema
from beatlake.plans.registry import GROUPS, JOBS, jobs_named
from beatlake.plans.runs import Run, row_counts, run_jobs
from beatlake.sources.dates import run_dates
from beatlake.sources.lake import PLATFORM, RUN_DATE, EventLake, Slice, load_users, raw_schema
from beatlake.sources.tables import write_days, write_run_days
from checks import adapters
from checks.queries import read_adapter, without

SMALL = "/root/testdata/sf0.001"
DAY_1, DAY_2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def at(day, hour, minute=0, second=0):
    return dt.datetime(2024, 1, day, hour, minute, second)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_contract(name, spark):
    """What a job builds covers its published columns, its key and its order, and dates every row."""
    job = JOBS[name]
    built = job.build(read_adapter(spark, SMALL, job), adapters.users(spark, SMALL))
    assert {*job.column_list, job.key, job.sort_key} <= set(built.columns)
    assert set(built.columns) - set(job.column_list) <= {
        "year", "month", "day", "context_ip", "context_locale", "context_page_referrer",
    }
    assert dict(built.dtypes)["year"] == "int"
    assert dict(built.dtypes)["month"] == dict(built.dtypes)["day"] == "string"
    kinds = dict(built.dtypes)
    assert all(kinds[name].removesuffix("_ntz") == kind for name, kind in published_schema(job))


def test_job_without_input_builds_nothing(spark):
    for job in JOBS.values():
        assert job.build(lambda feed: [], adapters.users(spark, SMALL)) is None


def test_groups():
    assert len(JOBS) == 61
    assert [len(GROUPS[name]) for name in ("core", "events_1", "events_2")] == [6, 24, 24]
    assert [job.name for job in jobs_named(["gate_backfill", "gate_signup_event", "deciles"])] == [
        "gate_login_complete", "gate_signup_complete", "gate_signup_event", "vod_deciles",
    ]
    with pytest.raises(ValueError, match="nothing_known"):
        jobs_named(["nothing_known"])


def test_run_dates():
    forward = run_dates("2024-02-28::2024-03-01")
    assert forward == run_dates("2024-03-01::2024-02-28")
    assert forward == [dt.date(2024, 3, 1), dt.date(2024, 2, 29), dt.date(2024, 2, 28)]
    assert run_dates("2024-01-05, 2024-01-02") == [dt.date(2024, 1, 5), dt.date(2024, 1, 2)]
    assert run_dates(" 2024-01-05 ") == [dt.date(2024, 1, 5)]
    for text in ("yesterday", "whatever"):
        assert run_dates(text, as_of=dt.date(2024, 3, 1)) == [dt.date(2024, 2, 29)]


def test_same_message_on_two_platforms_or_days_is_kept(spark):
    job = JOBS["search_event"]
    raw = adapters.raw_events(spark, SMALL, ("web",)).rows.limit(1)
    web = raw.withColumn(PLATFORM, F.lit("web"))
    copies = web.unionByName(web).unionByName(web.withColumn(PLATFORM, F.lit("ios")))
    copies = copies.unionByName(web.withColumn(RUN_DATE, F.lit("another")))
    assert job.build(lambda feed: [Slice(copies, ("web", "ios"))]).count() == 3


def test_optional_columns_default_to_null(spark):
    job = JOBS["page_event"]
    raw = adapters.raw_events(spark, SMALL, ("web",), titles=True)
    optional = {"user_tier": "string", "user_id": "string", "context_user_agent": "string", "on_mobile_device": "boolean"}
    nulls = {name: F.lit(None).cast(kind) for name, kind in optional.items()}
    blank = Slice(raw.rows.withColumns(nulls), raw.platforms)
    left_out = job.build(lambda feed: [without(raw, *optional)])
    assert rows_of(left_out) == rows_of(job.build(lambda feed: [blank]))
    assert left_out.where("user_tier = 'anon'").count() == left_out.count()


def test_false_and_platform_defaults(spark):
    raw = adapters.raw_events(spark, SMALL, ("web",))
    hero = JOBS["hero_event"].build(lambda feed: [without(raw, "has_sso", "has_video")])
    assert hero.select("has_sso", "has_video").distinct().collect() == [(False, False)]
    tested = JOBS["growthbook_test_hero_event"].build(lambda feed: [without(raw, "has_sso", "has_video")])
    assert tested.select("has_sso", "has_video").distinct().collect() == [(None, None)]
    shown = JOBS["hero_impression"].build(lambda feed: [without(raw, "platform")])
    assert shown.select("platform").distinct().collect() == [("web",)]


def test_required_columns_are_not_made_up(spark):
    raw = without(adapters.raw_events(spark, SMALL, ("web",)), "label")
    with pytest.raises(Exception, match="label"):
        JOBS["click_event"].build(lambda feed: [raw])


BEATS = [
    # session, content, anonymous, tier, user, position, percentage, time
    ("s1", "ep2", "a", None, None, 30, "0.15", at(1, 10, 0, 0)),
    ("s1", "ep1", "a", "first", "u1", 90, "0.25", at(1, 10, 0, 59)),
    ("s1", "ep1", "a", "first", "u1", 60, "0.251", at(1, 10, 0, 30)),
    ("s2", None, "b", "free", "u9", 10, "0.5", at(1, 9)),
    ("s2", "ep1", "b", "free", "u9", 20, "0.6", at(1, 23, 59, 45)),
    ("s3", None, "c", "free", "u1", 10, "0.5", at(1, 12)),
    (None, "ep1", "d", "free", "u1", 10, "0.5", at(1, 12)),
    ("s4", "ep4", "e", "Free", "u2", 5, None, None),
    ("s5", "ep5", "f", "Free", "u2", 5, "1.0", at(1, 1)),
]
BEAT_SCHEMA = (
    "session_id string, content_id string, anonymous_id string, user_tier string, user_id string, position bigint, "
    "percentage_watched string, received_at timestamp"
)


def beats(spark, platform="ios", day="2024-01-01"):
    rows = spark.createDataFrame(BEATS, BEAT_SCHEMA).withColumn("user_uuid", F.col("user_id"))
    return rows.withColumns({PLATFORM: F.lit(platform), RUN_DATE: F.lit(day)})


def user_rows(spark):
    return spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u2")], "user_key int, user_id string")


def test_vod_sessions(spark):
    found = JOBS["vod_sessions"].build(lambda feed: [Slice(beats(spark), ("ios",))], user_rows(spark))
    columns = [
        "session_id", "user_key", "user_tier", "episode_key", "active_seconds", "duration_seconds", "max_position",
        "on_mobile_device", "year", "month", "day",
    ]
    assert rows_of(found.select(*columns)) == [
        ("s120240101", 1, "premium", "ep1", 90, 89, 90, True, 2024, "01", "01"),
        ("s220240101", None, "anon", "ep1", 60, 53985 + 30, 20, True, 2024, "01", "01"),
        ("s520240101", 2, "free", "ep5", 30, 30, 5, True, 2024, "01", "01"),
    ]


def test_vod_sessions_per_platform_and_day(spark):
    slices = [
        Slice(beats(spark), ("ios",)),
        Slice(beats(spark, "lr_roku"), ("lr_roku",)),
        Slice(beats(spark, "lr_roku", "2024-01-02"), ("lr_roku",)),
    ]
    found = JOBS["vod_sessions"].build(lambda feed: slices, user_rows(spark))
    assert rows_of(found.groupBy("platform", "on_mobile_device").count()) == [("ios", True, 3), ("lr_roku", False, 6)]


def test_vod_deciles(spark):
    found = JOBS["vod_deciles"].build(lambda feed: [Slice(beats(spark, "web"), ("web",))], user_rows(spark))
    columns = ["session_id", "user_key", "user_tier", "episode_key", "start_timestamp", "decile", "year", "month"]
    assert rows_of(found.select(*columns)) == sorted(
        [
            ("s1", 1, "premium", "ep1", at(1, 10), 10, 2024, "01"),
            ("s1", None, "anon", "ep2", at(1, 10), 1, 2024, "01"),
            ("s2", None, "anon", "ep1", at(1, 9), 100000, 2024, "01"),
            ("s4", 2, "free", "ep4", None, 0, None, "null"),
            ("s4", 3, "free", "ep4", None, 0, None, "null"),
            ("s5", 2, "free", "ep5", at(1, 1), 1000000000, 2024, "01"),
            ("s5", 3, "free", "ep5", at(1, 1), 1000000000, 2024, "01"),
        ],
        key=repr,
    )


def test_concurrents_halve_and_truncate(spark):
    times = [at(1, 10, 0, 0), at(1, 10, 0, 30), at(1, 10, 0, 59), at(1, 10, 1, 0), None]
    rows = spark.createDataFrame([(time,) for time in times], "received_at timestamp")
    rows = rows.withColumns({PLATFORM: F.lit("web"), RUN_DATE: F.lit("2024-01-01")})
    found = JOBS["live_concurrents"].build(lambda feed: [Slice(rows, ("web",))])
    assert rows_of(found.select("session_id", "count", "platform", "year", "month", "day")) == [
        ("2024-01-01 10:00:00web", 1, "web", 2024, "01", "01"),
        ("2024-01-01 10:01:00web", 0, "web", 2024, "01", "01"),
    ]


def test_visits_pick_one_user_column_per_schema(spark):
    base = spark.createDataFrame(
        [("m1", "a", at(1, 1), "u1", "u2"), ("m2", "b", at(1, 2), None, "u2"), ("m3", None, at(1, 3), "u1", "u1")],
        "id string, anonymous_id string, received_at timestamp, user_id string, user_uuid string",
    ).withColumns({PLATFORM: F.lit("web"), RUN_DATE: F.lit("2024-01-01")})

    def keys(*absent):
        raw = Slice(base.drop(*absent), ("web",))
        return rows_of(JOBS["fact_visits"].build(lambda feed: [raw], user_rows(spark)).select("message_id", "user_key"))

    assert keys() == [("m1", 1), ("m2", None)]
    assert keys("user_id") == [("m1", 2), ("m2", 2)]
    assert keys("user_id", "user_uuid") == [("m1", None), ("m2", None)]


# Runs


def write_raw(lake, segment_type, platform, rows):
    write_days(rows, lake.feed_root(segment_type, platform))


@pytest.fixture
def lake(spark, tmp_path):
    """Sign-up clicks of two days: ios has the mobile flag on the second only, web on both, android has none."""
    lake = EventLake(spark, str(tmp_path / "raw"))
    base = spark.createDataFrame(
        [
            ("m1", "a", "home", at(1, 5), 2024, "01", "01"),
            ("m1", "a", "top", at(1, 4), 2024, "01", "01"),
            ("m2", "b", "home", at(2, 5), 2024, "01", "02"),
            # Received on the first day but loaded into the second one's folder, as late events are.
            ("m1", "a", "late", at(1, 6), 2024, "01", "02"),
        ],
        "id string, anonymous_id string, location string, received_at timestamp, year int, month string, day string",
    )
    flagged = base.withColumn("on_mobile_device", F.lit(None).cast("boolean"))
    write_raw(lake, "signup_button_clicked", "ios", base.where("day = '01'"))
    write_raw(lake, "signup_button_clicked", "ios", flagged.where("day = '02'"))
    write_raw(lake, "signup_button_clicked", "web", flagged)
    users = spark.createDataFrame([(1, "u1", "x")], "user_key int, user_id string, name string")
    Run(spark, lake.root, str(tmp_path / "out"), ()).export_users(users)
    return lake


def test_lake_tells_days_with_a_column_from_days_without(lake, spark, tmp_path):
    run = Run(spark, lake.root, str(tmp_path / "out"), (DAY_1, DAY_2))
    built = run.build(JOBS["signup_button_clicked"])
    columns = ["event_id", "location", "platform", "on_mobile_device", "day"]
    assert rows_of(built.select(*columns)) == sorted(
        [
            ("m1", "top", "ios", True, "01"),
            ("m2", "home", "ios", None, "02"),
            ("m1", "late", "ios", None, "01"),
            ("m1", "top", "web", None, "01"),
            ("m2", "home", "web", None, "02"),
            ("m1", "late", "web", None, "01"),
        ],
        key=repr,
    )


def test_scan_of_missing_days_and_platforms(lake):
    assert lake.scan("signup_button_clicked", "lr_roku", [DAY_1]) is None
    assert lake.scan("signup_button_clicked", "web", [dt.date(2023, 1, 1)]) is None
    assert lake.scan("signup_button_clicked", "web", [DAY_1, dt.date(2023, 1, 1)]).rows.count() == 2
    assert lake.slices(Feed("nothing", ("web",)), [DAY_1]) == []


def test_unknown_platform_reads_the_fallback_source(lake):
    assert lake.feed_root("x", "fridge") == lake.feed_root("x", "android")


def test_unreadable_input_is_an_error(lake, spark, tmp_path):
    folder = tmp_path / "raw" / "broken"
    folder.mkdir(parents=True)
    (folder / "part.parquet").write_text("not parquet")
    from beatlake.sources.lake import read_parquet

    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read_parquet(spark, str(folder))


def test_process_and_publish_twice(lake, spark, tmp_path):
    job, other = JOBS["signup_button_clicked"], JOBS["click_event"]
    run = Run(spark, lake.root, str(tmp_path / "out"), (DAY_1, DAY_2))
    target = ParquetTarget(spark, str(tmp_path / "house"))
    for _ in range(2):
        assert run.process(other) == run.process(job) == []
        run.publish(job, target)
        run.publish(other, ParquetTarget(spark, str(tmp_path / "nothing")))
    published = target.read()
    assert published.columns == list(job.column_list)
    assert rows_of(published.groupBy("event_id", "location").count()) == [("m1", "top", 1), ("m2", "home", 1)]
    assert not (tmp_path / "out/click_event").exists()
    assert not (tmp_path / "nothing").exists()
    assert load_users(spark, run.path("dim_user")).columns == ["user_key", "user_id"]


def day_table(spark, run, job):
    table = spark.read.parquet(run.path(job.name))
    return rows_of(table.select("event_id", "location", "platform", F.col("day").cast("int")))


def test_late_events_stand_beside_their_day_through_reruns(lake, spark, tmp_path):
    """The second day's run holds an event of the first day, whose id the first run has already."""
    job = JOBS["signup_button_clicked"]
    first, second = (Run(spark, lake.root, str(tmp_path / "out"), (day,)) for day in (DAY_1, DAY_2))
    assert first.process(job) == []
    before = day_table(spark, first, job)
    later = [("m1", "late", name, 1) for name in ("ios", "web")] + [("m2", "home", name, 2) for name in ("ios", "web")]
    for run in (second, second, first):
        assert run.process(job) == ([DAY_1] if run is second else [])
        assert day_table(spark, run, job) == sorted(before + later, key=repr)


def test_a_rerun_takes_back_what_it_no_longer_holds(spark, tmp_path):
    kind = "id string, n int, year int, month string, day string, input_day string"
    path = str(tmp_path / "t")

    def write(day, *rows):
        frame = spark.createDataFrame([(*row, day.isoformat()) for row in rows], kind)
        return write_run_days(frame, path, [day])

    one, other, untimed = (2024, "01", "01"), (2024, "01", "02"), (None, "null", "null")
    assert write(DAY_1, ("a", 1, *one)) == []
    assert write(DAY_2, ("a", 2, *one), (None, 2, *one), ("b", 2, *other), ("c", 2, *untimed)) == [DAY_1]
    assert write(DAY_1, ("a", 3, *one), (None, 3, *one)) == []

    def found():
        return rows_of(spark.read.parquet(path).select("id", "n"))

    assert found() == [("a", 2), ("a", 3), ("b", 2), ("c", 2), (None, 2), (None, 3)]
    assert write(DAY_2, ("b", 4, *other)) == []
    assert found() == [("a", 3), ("b", 4), (None, 3)]
    assert write(DAY_2) == []
    assert found() == [("a", 3), (None, 3)]


@pytest.mark.parametrize("numbers_first", [True, False])
def test_types_of_a_day_table_do_not_depend_on_the_run(spark, tmp_path, numbers_first):
    job, lake = JOBS["livestream_heartbeat"], EventLake(spark, str(tmp_path / "raw"))
    kind = "id string, session_id string, anonymous_id string, received_at timestamp, year int, month string, day string"
    rows = spark.createDataFrame([(f"m{day}", "s", "a", at(day, 5), 2024, "01", f"0{day}") for day in (1, 2)], kind)
    number, text = ("01", "02") if numbers_first else ("02", "01")
    write_raw(lake, "livestream_heartbeat", "web", rows.where(f"day = '{number}'").withColumn("user_tier", F.lit(7)))
    write_raw(lake, "livestream_heartbeat", "web", rows.where(f"day = '{text}'").withColumn("user_tier", F.lit("x")))
    tables = []
    for name, runs in (("joint", [(DAY_1, DAY_2)]), ("single", [(DAY_1,), (DAY_2,)])):
        for days in runs:
            run = Run(spark, lake.root, str(tmp_path / name), days)
            run.process(job)
        table = spark.read.parquet(run.path(job.name))
        assert {(column, dict(table.dtypes)[column]) for column in job.column_list} == set(published_schema(job))
        tables.append(rows_of(table.select("heartbeat_id", "user_tier", "event_timestamp")))
    assert tables[0] == tables[1] and sorted(row[1] for row in tables[0]) == ["7", "x"]


def jobs_started(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_declared_scans_open_no_files(spark, tmp_path):
    lake, declared = EventLake(spark, str(tmp_path / "raw")), raw_schema(["id", "received_at", "late_column"])
    rows = spark.createDataFrame(
        [(f"m{day}", at(day, 5), 2024, "01", f"0{day}") for day in range(1, 10)],
        "id string, received_at timestamp, year int, month string, day string",
    )
    write_raw(lake, "feed", "web", rows)
    days = [dt.date(2024, 1, day) for day in range(1, 10)]
    found = []
    assert jobs_started(spark, "declared", lambda: found.append(lake.scan("feed", "web", days, declared))) == 0
    assert rows_of(found[0].rows.select("id", "late_column"))[0] == ("m1", None)
    feed = Feed("feed", ("web",), ("late_column",), reads=("id", "received_at", "late_column"))
    assert jobs_started(spark, "one footer", lambda: found.append(lake.slices(feed, days)[0])) <= 1
    assert rows_of(found[0].rows) == rows_of(found[1].rows)
    with pytest.raises(Exception, match="late_column"):
        lake.slices(Feed("feed", ("web",), reads=("id", "late_column")), days)[0].rows.select("late_column")


def test_concurrents_add_up_the_input_days_of_a_minute(spark, tmp_path):
    lake, job = EventLake(spark, str(tmp_path / "raw")), JOBS["live_concurrents"]
    rows = [(at(1, 10, 0, 1), "01"), (at(1, 10, 0, 31), "02"), (at(1, 10, 0, 32), "02"), (at(2, 9), "02")]
    frame = spark.createDataFrame([(time, 2024, "01", day) for time, day in rows], "received_at timestamp, year int, month string, day string")
    write_raw(lake, "livestream_heartbeat", "web", frame)
    for day in (DAY_1, DAY_2, DAY_1):
        run = Run(spark, lake.root, str(tmp_path / "out"), (day,))
        late = run.process(job)
        assert late == ([DAY_1] if day == DAY_2 else [])
    assert rows_of(run.staged(job).select("start_timestamp", "count")) == [(at(1, 10), 1)]
    assert Run(spark, lake.root, str(tmp_path / "out"), (DAY_2,)).staged(job, [DAY_1]).count() == 2


def scans_of(frame):
    """Scans that a frame's final plan runs; what a reused exchange stands for is not run again."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan


def test_deciles_scan_their_feed_once(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    beats(spark, "web").write.parquet(str(tmp_path / "beats"))
    raw = Slice(spark.read.parquet(str(tmp_path / "beats")), ("web",))
    found = JOBS["vod_deciles"].build(lambda feed: [raw], user_rows(spark))
    plan = scans_of(found)
    assert plan.count("FileScan parquet") - plan.count("ReusedExchange") <= 1 and "ReusedExchange" in plan


def test_a_small_merge_does_not_shuffle_the_published_table(spark, tmp_path):
    path = str(tmp_path / "published")
    spark.range(1000).selectExpr("cast(id AS string) AS id", "id AS n").write.parquet(path)
    stage = spark.createDataFrame([("5", 1), ("x", 2)], "id string, n long")
    new = absent(stage, spark.read.parquet(path), ["id"])
    assert rows_of(new) == [("x", 2)]
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert any("BroadcastHashJoin" in line and "LeftSemi, BuildRight" in line for line in plan.splitlines())


def test_late_events_reach_a_day_that_has_no_table_yet(lake, spark, tmp_path):
    job = JOBS["signup_button_clicked"]
    run = Run(spark, lake.root, str(tmp_path / "out"), (DAY_2,))
    target = ParquetTarget(spark, str(tmp_path / "house"))
    run.publish(job, target, run.process(job))
    assert rows_of(target.read().groupBy("event_id", "location").count()) == [("m1", "late", 1), ("m2", "home", 1)]


def test_command_line(lake, spark, tmp_path, monkeypatch):
    from beatlake.__main__ import main

    arguments = ["beatlake", "signup_button_clicked", "--dates", "2024-01-02::2024-01-01", "--lake", lake.root]
    arguments += ["--processed", str(tmp_path / "out"), "--warehouse", str(tmp_path / "house")]
    monkeypatch.setattr("sys.argv", arguments)
    main()
    assert spark.read.parquet(str(tmp_path / "house/signup_button_clicked")).count() == 2


def test_command_line_exports_users(spark, tmp_path, monkeypatch):
    from beatlake.__main__ import main

    given = str(tmp_path / "given")
    user_rows(spark).write.parquet(given)
    arguments = ["beatlake", "--users", given, "--lake", str(tmp_path), "--processed", str(tmp_path / "out")]
    monkeypatch.setattr("sys.argv", arguments)
    main()
    assert load_users(spark, str(tmp_path / "out/dim_user")).count() == 3


def test_one_failing_job_leaves_the_others_published(lake, spark, tmp_path):
    run = Run(spark, lake.root, str(tmp_path / "out"), (DAY_1, DAY_2))
    write_raw(lake, "click_event", "web", spark.createDataFrame([("x", 2024, "01", "01")], "id string, year int, month string, day string"))
    rows = [(f"b{n}", n, at(1, n), 2024, "01", "01") for n in range(3)]
    kind = "id string, position int, received_at timestamp, year int, month string, day string"
    write_raw(lake, "livestream_heartbeat", "web", spark.createDataFrame(rows, kind))
    names = ["signup_button_clicked", "click_event", "live_concurrents"]

    def work(job):
        run.publish(job, ParquetTarget(spark, str(tmp_path / f"house/{job.name}")), run.process(job))

    with pytest.raises(ExceptionGroup) as failed:
        run_jobs(spark, jobs_named(names), work, 2)
    assert [error.__notes__ for error in failed.value.exceptions] == [["job click_event"]]
    assert sorted(path.name for path in (tmp_path / "house").iterdir()) == ["live_concurrents", "signup_button_clicked"]


def test_writing_days_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [("a", 2024, "01", "01"), ("b", 2024, "01", "02")], "id string, year int, month string, day string"
    )
    write_days(rows, path)
    write_days(rows.where("day = '02'").withColumn("id", F.lit("c")), path)
    assert rows_of(spark.read.parquet(path).select("id", "month", "day")) == [("a", "01", "01"), ("c", "01", "02")]


def test_a_day_without_time_is_written_under_text_null(spark, tmp_path):
    rows = spark.createDataFrame([("a", None, "null", "null")], "id string, year int, month string, day string")
    write_days(rows, str(tmp_path / "t"))
    assert (tmp_path / "t/year=__HIVE_DEFAULT_PARTITION__/month=null/day=null").exists()


def test_row_counts_leave_out_jobs_without_input(spark):
    rows = spark.range(3)
    assert rows_of(row_counts([("a", rows), ("b", None), ("c", rows.limit(1))])) == [("a", 3), ("c", 1)]
