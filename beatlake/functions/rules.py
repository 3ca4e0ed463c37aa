"""Column rules of the event jobs, all of them built-in Spark expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide what lands in the published tables.
BOT_WORDS = ("bot", "spider", "crawl")
MOBILE_PLATFORMS = ("ios", "android")
TV_PLATFORMS = ("lr_apple", "lr_fire", "lr_roku", "lr_xbox", "lr_android")
BREAK_TYPES = {"pre-roll": ("preroll", "PREROLL"), "mid-roll": ("midroll", "MIDROLL")}
TARGET_TYPES = {"series": ("show", "shows"), "episodes": ("episode", "epısode")}
BEAT_SECONDS = 30


def two_digits(number: Column) -> Column:
    return F.coalesce(F.lpad(number.cast("string"), 2, "0"), F.lit("null"))


def date_parts(moment: Column) -> list[Column]:
    """year as a number, month and day as two-digit text.

    A missing moment gives a NULL year and the text 'null' for the other two.
    """
    return [
        F.year(moment).alias("year"),
        two_digits(F.month(moment)).alias("month"),
        two_digits(F.dayofmonth(moment)).alias("day"),
    ]


def is_not_bot(agent: Column) -> Column:
    """Rows without an agent stay; the match is case-sensitive and on substrings."""
    return agent.isNull() | ~reduce(or_, (agent.contains(word) for word in BOT_WORDS))


def event_tier(tier: Column, user: Column) -> Column:
    """Tier of a single event: free and unknown tiers depend on whether a user is known."""
    tier = F.lower(tier)
    signed_in = F.when(user.isNull(), "anon").otherwise("free")
    return F.when(tier.isNull() | (tier == "free"), signed_in).otherwise(tier)


def session_tier(tier: Column, user_key: Column) -> Column:
    """Tier of a session: as event_tier on the dimension match, and 'first' is premium."""
    return F.when(F.lower(tier) == "first", "premium").otherwise(event_tier(tier, user_key))


def renamed(value: Column, names: dict[str, tuple[str, ...]]) -> Column:
    """Exact-match renaming; every other value, NULL included, is unchanged."""
    result = value
    for new, old in names.items():
        result = F.when(value.isin(*old), new).otherwise(result)
    return result


def ascii_text(value: Column) -> Column:
    """Non-ASCII characters dropped. Empty text becomes NULL, text without ASCII becomes ''.

    Text with as many bytes as characters is ASCII already and skips the replacement.
    """
    stripped = F.regexp_replace(value, r"[^\x00-\x7F]+", "")
    plain = F.octet_length(value) == F.char_length(value)
    return F.when(F.length(value) > 0, F.when(plain, value).otherwise(stripped))


def mobile_flag(platform: Column, tv_is_false: bool = False) -> Column:
    """The flag for feeds that lack it: phones are TRUE, TVs FALSE if asked, others NULL."""
    flag = F.when(platform.isin(*MOBILE_PLATFORMS), F.lit(True))
    if tv_is_false:
        flag = flag.when(platform.isin(*TV_PLATFORMS), F.lit(False))
    return flag


def whole_number(value: Column, kind: str) -> Column:
    """A column of type ``kind`` as INT, NULL where it is no such number; fractions are cut off.

    Text is matched first: a strict cast refuses '12.7', and each refusal costs an exception.
    """
    if kind != "string":
        return value.try_cast("int")
    number = r"^([+-]?)0*(\d{1,10})(\.\d*)?$"
    text = F.trim(value)
    whole = F.when(text.rlike(number), F.regexp_replace(text, number, "$1$2").cast("bigint"))
    return F.when(whole.between(-(2**31), 2**31 - 1), whole.cast("int"))


def decile(percentage: Column) -> Column:
    """1 to 10 for the tenth of the video reached, 0 below 10 %, above 109 % or unknown.

    The share runs through 32-bit floats in both roundings, which decides the exact tenths.
    """
    share = F.round(percentage.try_cast("float"), 4)
    percent = F.round(share * F.lit(100).cast("float"), 0).try_cast("int")
    tenth = F.floor(percent / 10).cast("int")
    return F.when(tenth.between(1, 10), tenth).otherwise(0)


def decile_weight(tenth: Column) -> Column:
    """Decimal digit of a decile: 1, 10, 100 and so on for 1, 2, 3; 0 for 0."""
    return F.when(tenth > 0, F.pow(F.lit(10), tenth - 1)).otherwise(0).cast("int")


def decile_bit(tenth: Column) -> Column:
    """One bit per decile, so that bit_or gathers the deciles seen."""
    return F.when(tenth > 0, F.pow(F.lit(2), tenth - 1)).otherwise(0).cast("int")


def decile_digits(bits: Column) -> Column:
    """A gathered bit set as a decimal number whose k-th digit is 1 if decile k was seen."""
    return sum(
        (F.getbit(bits, F.lit(k)).cast("bigint") * F.lit(10**k).cast("bigint") for k in range(1, 10)),
        F.getbit(bits, F.lit(0)).cast("bigint"),
    )


def truncated(name: str, length: int) -> Column:
    """The first characters of a column, counted in characters."""
    return F.substring(F.col(name), 1, length)
