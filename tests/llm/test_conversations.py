"""Conversation repair against every edit sequence, in one part and in many."""

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from beatlake.llm import conversations
from beatlake.llm.conversations import AUDIT_SQL, COUNTS

COLUMNS = ["conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"]


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        known = ["" if x is None else x for x in ()]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text, *known)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))


def brute_repair(rows):
    """The least (cost, audit, lines) over all edit sequences, by plain recursion."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
        faults.append(fault)
        seen.add((role, text))

    def fits(initials):
        return re.fullmatch("(s?(ua)+)?", initials) or re.fullmatch("(s?(ua)*u?)?", initials)

    def short(initials):  # what later rows depend on
        return initials if len(initials) < 2 else "s" if initials == "s" else "u" if initials[-1] == "u" else "ua"

    @cache
    def best(at, initials):
        found = []
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            found.append((0, "", ()))
        if at < len(rows):
            _, role, text = rows[at]
            more = faults[at] == "truncated"
            cost, audit, lines = best(at + 1, initials)
            found.append((3 + cost, "D" + audit, lines))
            if faults[at] not in ("blank", "duplicate"):
                for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if name and fits(initials + name[0]):
                        cost, audit, lines = best(at + 1, short(initials + name[0]))
                        found.append((price + more + cost, letter + audit, (f"{name}:{text}", *lines)))
        for name, times in (("user", 1), ("assistant", 1)):
            if fits(initials + name[0]) and not (initials[-1:] == "a" and at == len(rows)):
                rest = inserted(at, short(initials + name[0]))
                found.append((2 + rest[0], "I" + rest[1], (f"{name}:", *rest[2])))
        return min(found, key=lambda x: x[:2])

    @cache
    def inserted(at, initials):
        """As ``best`` after an insertion; two insertions in a row are enough."""
        found = []
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            found.append((0, "", ()))
        if at < len(rows):
            _, role, text = rows[at]
            more = faults[at] == "truncated"
            cost, audit, lines = best(at + 1, initials)
            found.append((3 + cost, "D" + audit, lines))
            if faults[at] not in ("blank", "duplicate"):
                for letter, name, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if name and fits(initials + name[0]):
                        cost, audit, lines = best(at + 1, short(initials + name[0]))
                        found.append((price + more + cost, letter + audit, (f"{name}:{text}", *lines)))
        if initials[-1:] == "u":
            cost, audit, lines = inserted(at, "ua")
            found.append((2 + cost, "I" + audit, ("assistant:", *lines)))
        return min(found, key=lambda x: x[:2])

    return faults, best(0, "")


def brute_row(conv, rows):
    faults, (cost, audit, lines) = brute_repair(rows)
    turns = {turn for turn, _, _ in rows if turn is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [faults.count(name) for name in COUNTS[:3]]
    return (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made_up(seed):
    random.seed(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "no", "why?", "   ", None, "", "so!\n", "x.y", "Yes. "]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(random.choice([0, 1, 2, 5, 9])):
            where = random.choice([turn, turn, turn, turn + 3, None])
            role = roles[turn % 2] if random.random() < 0.6 else random.choice(roles)
            rows.append((conv, where, role, random.choice(texts)))
    rows += [(777, n, random.choice(roles[:3]), random.choice([f"part {n}.", f"part {n}", "Yes.", ""])) for n in range(150)]
    return rows + [(500, 0, "user", "gone."), (501, None, None, None)]


@pytest.mark.parametrize("limits", [(4096, 1 << 20), (3, 1 << 20), (4096, 5)])
def test_repair_equals_all_edits(spark, limits):
    rows = made_up(3)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    found = {row.conv_id: tuple(row[name] for name in COLUMNS) for row in conversations.audited(frame, *limits).collect()}
    by_conv = {conv: [row for row in rows if row[0] == conv] for conv in {row[0] for row in rows}}
    assert found.keys() == by_conv.keys()
    for conv, own in by_conv.items():
        assert found[conv] == brute_row(conv, brute_damage(own))


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_repair_equals_sql_in_parts(spark, sf):
    path = f"/root/testdata/{sf}/conversations.parquet"
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    found = conversations.audited(spark.read.parquet(path), 3).select(*COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(duck.execute(AUDIT_SQL).fetchall())


@given(st.lists(st.integers(0, 8), max_size=40), st.integers(0, 8), st.integers(0, 300))
@settings(max_examples=200, deadline=None)
def test_powers_equal_single_rows(symbols, long, times):
    symbols = symbols + [long] * times + symbols
    single = conversations.AT_END
    for symbol in reversed(symbols):
        single = conversations.advance(conversations.power(symbol, 0), single)
    assert conversations.costs_before(symbols, conversations.AT_END)[1] == single[0]
    assert conversations.advance(conversations.matrix_of(symbols), conversations.AT_END) == single
    audit, _ = conversations.audit_of(symbols, conversations.AT_END, 0, True)
    assert len(audit.replace("I", "")) == len(symbols)


def test_no_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.audited(empty).count() == 0
    gone = next(n for n in range(1000) if zlib.crc32(f"{n}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.", "x", True)] * 3 + [(-5, 0, "user", "word " * 300_000, "y", False)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, whole boolean")
    found = {row.conv_id: row for row in conversations.audited(frame).collect()}
    assert tuple(found[gone])[:7] == (gone, 0, 0, 0, 0, 0, 0) and found[gone].audit == ""
    assert found[gone].repaired_sha256 == hashlib.sha256(b"").hexdigest()
    assert found[-5].truncated == 1 and len(found[-5].audit.replace("I", "")) == 1
