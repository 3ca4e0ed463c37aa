"""Column rules on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from beatlake.functions import rules


def results(spark, values, kind, make):
    rows = spark.createDataFrame([(at, value) for at, value in enumerate(values)], f"at int, value {kind}")
    return [row.result for row in rows.select("at", make(F.col("value")).alias("result")).orderBy("at").collect()]


def test_bot_match_is_case_sensitive_and_keeps_missing_agents(spark):
    agents = [None, "", "Googlebot", "BOT", "my spider", "Crawler", "webcrawl", "Safari"]
    assert results(spark, agents, "string", rules.is_not_bot) == [True, True, False, True, False, True, False, True]


def test_ascii_text(spark):
    values = [None, "", "abc", "Café – é", "éé", "a\u007fb\U0001f600c"]
    assert results(spark, values, "string", rules.ascii_text) == [None, None, "abc", "Caf  ", "", "a\u007fbc"]


@pytest.mark.parametrize(
    ("tier", "user", "event", "session"),
    [
        (None, None, "anon", "anon"),
        (None, "7", "free", "free"),
        ("FREE", None, "anon", "anon"),
        ("Free", "7", "free", "free"),
        ("First", None, "first", "premium"),
        ("first", "7", "first", "premium"),
        ("Premium", None, "premium", "premium"),
        ("", None, "", ""),
    ],
)
def test_tiers(spark, tier, user, event, session):
    rows = spark.createDataFrame([(tier, user)], "tier string, user string")
    found = rows.select(
        rules.event_tier(F.col("tier"), F.col("user")), rules.session_tier(F.col("tier"), F.col("user"))
    ).first()
    assert tuple(found) == (event, session)


def test_renaming_is_exact(spark):
    values = ["preroll", "PREROLL", "Preroll", "MIDROLL", "postroll", None]
    found = results(spark, values, "string", lambda c: rules.renamed(c, rules.BREAK_TYPES))
    assert found == ["pre-roll", "pre-roll", "Preroll", "mid-roll", "postroll", None]
    values = ["shows", "epısode", "episode", "Episode", None]
    found = results(spark, values, "string", lambda c: rules.renamed(c, rules.TARGET_TYPES))
    assert found == ["series", "episodes", "episodes", "Episode", None]


def test_missing_time_gives_text_null_for_month_and_day(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 3, 9),), (None,)], "moment timestamp")
    assert [tuple(row) for row in rows.select(*rules.date_parts(F.col("moment"))).collect()] == [
        (2024, "03", "09"),
        (None, "null", "null"),
    ]


def test_whole_number_cuts_fractions_and_refuses_the_rest(spark):
    values = ["12", " 12 ", "12.7", "-3.9", "7.", "0", "000000000000012", "n/a", "", "1e3", "12.7abc", None]
    found = results(spark, values, "string", lambda c: rules.whole_number(c, "string"))
    assert found == [12, 12, 12, -3, 7, 0, 12, None, None, None, None, None]
    edges = ["2147483647", "2147483648", "-2147483648", "-2147483649", "99999999999"]
    found = results(spark, edges, "string", lambda c: rules.whole_number(c, "string"))
    assert found == [2147483647, None, -2147483648, None, None]
    numbers = results(spark, [1.5e7, 2.9, None], "double", lambda c: rules.whole_number(c, "double"))
    assert numbers == [15000000, 2, None]


def test_deciles_follow_32_bit_rounding(spark):
    values = ["0.0", "0.094", "0.095", "0.195", "0.695", "0.895", "0.5", "0.999", "1.0", "1.1", "x", None, "NaN"]
    found = results(spark, values, "string", rules.decile)
    # The four .095-like shares sit on a rounding edge that 32 and 64 bits decide differently.
    assert found[2:6] == [rules_decile(value) for value in values[2:6]]
    assert found[:2] + found[6:] == [0, 0, 5, 10, 10, 0, 0, 0, 0]


def rules_decile(text):
    import numpy as np

    share = np.float32(round(float(np.float32(text)), 4))
    percent = np.float32(share * np.float32(100))
    whole = int(np.floor(percent + np.float32(0.5)))
    return whole // 10 if 1 <= whole // 10 <= 10 else 0


def test_decile_digits_equal_the_distinct_sum(spark):
    seen = [0, 1, 2, 2, 4, 10]
    rows = spark.createDataFrame([(tenth,) for tenth in seen], "tenth int")
    found = rows.agg(
        F.sum_distinct(rules.decile_weight(F.col("tenth"))).alias("sum"),
        rules.decile_digits(F.bit_or(rules.decile_bit(F.col("tenth")))).alias("digits"),
    ).first()
    assert found["sum"] == found["digits"] == 1000001011


def test_mobile_flag(spark):
    platforms = ["ios", "android", "web", "lr_roku"]
    assert results(spark, platforms, "string", rules.mobile_flag) == [True, True, None, None]
    with_tv = results(spark, platforms, "string", lambda c: rules.mobile_flag(c, tv_is_false=True))
    assert with_tv == [True, True, None, False]
