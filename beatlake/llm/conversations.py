"""Repair of conversation structure at least cost, run by run.

A conversation is well formed if its role initials match ``(s?(ua)+)?``. Four states follow that pattern: nothing yet,
after s, after u, after a. A row is one of nine symbols (its initial and whether it is cut off, or that it has to go),
and a symbol is a min-plus matrix: the least cost from state to state over insertions before the row and what is done
with it. Equal consecutive symbols are one run, and a run advances the costs by binary powers of its matrix, which are
cached like the steps themselves. The choices are unrolled from those powers by halves, the ASCII-least letter of all
that keep the cost first; as a letter and a state give the next state, that is the least audit of all.

Rows are dealt by ranges of conversation and turn and cut into parts of bounded size. A conversation in one part is
repaired where it lies. Those that stretch over several (at the edge of a task, or very long) are joined by what is
associative: matrices of the parts give the costs after each part, those the choices of a part from each of the four
states, and a walk over the parts' ends picks one. No task holds more than a part of a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import SPACES, Scratch

PART_ROWS = 4096
PART_BYTES = 1 << 20
FAR = 1 << 60

# What the edits cost.
REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1

STATES = range(4)
KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "?": {}}
WANTED = (2, 2, 3, 2)  # the state after the one role that a new or renamed row can have
ROLES = {2: "user", 3: "assistant"}
AT_END = (0, 2 * INSERT, INSERT, 0)
GONE = 0  # the symbol of blank and repeated rows
INITIALS = "sua?"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

Rows = Iterator[pa.RecordBatch]
Matrix = tuple[tuple[int, ...], ...]
Costs = tuple[int, ...]


def initial(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "?"


def symbol_of(role: str, fault: str | None) -> int:
    return GONE if fault in ("blank", "duplicate") else 1 + 2 * INITIALS.index(initial(role)) + (fault == "truncated")


def times(one: Matrix, other: Matrix) -> Matrix:
    return tuple(tuple(min(FAR, min(row[k] + other[k][t] for k in STATES)) for t in STATES) for row in one)


def _moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, next state and cost of what can be done with a row."""
    moves = [("D", state, DELETE)]
    if symbol != GONE:
        own, more = INITIALS[(symbol - 1) // 2], CUT_OFF * ((symbol - 1) % 2)
        if state in KEPT[own]:
            moves.append(("K", KEPT[own][state], more))
        moves.append(("R", WANTED[state], REROLE + more))
    return moves


@cache
def power(symbol: int, level: int) -> Matrix:
    """The matrix of 2^level rows of one symbol."""
    if level:
        return times(power(symbol, level - 1), power(symbol, level - 1))
    inserted = [[0 if s == t else FAR for t in STATES] for s in STATES]
    row = [[FAR] * 4 for _ in STATES]
    for state in STATES:
        at, cost = state, 0
        for _ in STATES:
            at, cost = WANTED[at], cost + INSERT
            inserted[state][at] = min(inserted[state][at], cost)
        for _, after, cost in _moves(symbol, state):
            row[state][after] = min(row[state][after], cost)
    return times(tuple(map(tuple, inserted)), tuple(map(tuple, row)))


def advance(matrix: Matrix, after: Costs) -> Costs:
    return tuple(min(row[t] + after[t] for t in STATES) for row in matrix)


@cache
def before(symbol: int, level: int, after: Costs) -> tuple[Costs, int]:
    """Costs to the end before 2^level rows, given those after them; the least is taken off and returned."""
    costs = advance(power(symbol, level), after)
    least = min(costs)
    return tuple(cost - least for cost in costs), least


@cache
def unrolled(symbol: int, level: int, state: int, after: Costs) -> tuple[str, int]:
    """The least letters of 2^level rows from a state, and the state behind them."""
    if level:
        middle, _ = before(symbol, level - 1, after)
        left, between = unrolled(symbol, level - 1, state, middle)
        right, end = unrolled(symbol, level - 1, between, after)
        return left + right, end
    costs = advance(power(symbol, 0), after)
    letters = ""
    while True:
        moves = {letter: (end, cost) for letter, end, cost in _moves(symbol, state) if cost + after[end] == costs[state]}
        if "D" not in moves and INSERT + costs[WANTED[state]] == costs[state]:
            letters, state = letters + "I", WANTED[state]
        else:
            letter = min(moves)
            return letters + letter, moves[letter][0]


def runs_of(symbols: list[int]) -> list[tuple[int, int]]:
    return [(symbol, len(list(same))) for symbol, same in groupby(symbols)]


def _blocks(symbols: list[int]) -> list[tuple[int, int]]:
    """The runs as (symbol, level) blocks of 2^level rows."""
    return [(symbol, level) for symbol, n in runs_of(symbols) for level in reversed(range(n.bit_length())) if n >> level & 1]


def matrix_of(symbols: list[int]) -> Matrix:
    whole: Matrix = tuple(tuple(0 if s == t else FAR for t in STATES) for s in STATES)
    for symbol, level in _blocks(symbols):
        whole = times(whole, power(symbol, level))
    return whole


def costs_before(symbols: list[int], after: Costs) -> tuple[list[Costs], int]:
    """Costs after each block, each with its least taken off, and the least cost of all rows from the first state."""
    least = min(after)
    after, total, found = tuple(cost - least for cost in after), least, []
    for symbol, level in reversed(_blocks(symbols)):
        found.append(after)
        after, least = before(symbol, level, after)
        total += least
    return found[::-1], total + after[0]


def audit_of(symbols: list[int], after: Costs, state: int, last: bool) -> tuple[str, int]:
    """The letters of all rows from a state, with the insertions at the end of the conversation if this is its end."""
    letters = []
    for (symbol, level), costs in zip(_blocks(symbols), costs_before(symbols, after)[0]):
        found, state = unrolled(symbol, level, state, costs)
        letters.append(found)
    while last and AT_END[state]:
        letters.append("I")
        state = WANTED[state]
    return "".join(letters), state


def repaired(roles: list[str], texts: list[str], audit: str, state: int) -> tuple[list[str], list[str]]:
    """The rows that an audit leaves, from the state before them."""
    out: tuple[list[str], list[str]] = ([], [])
    at = 0
    for letter in audit:
        if letter == "K":
            state = KEPT[initial(roles[at])][state]
            out[0].append(roles[at])
        elif letter in "IR":
            state = WANTED[state]
            out[0].append(ROLES[state])
        if letter in "KR":
            out[1].append(texts[at])
        elif letter == "I":
            out[1].append("")
        at += letter != "I"
    return out


def row_key(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def faults_of(roles: list[str], texts: list[str], repeated: set[int]) -> list[str | None]:
    """Each row's first fault; ``repeated`` has the places of rows that are known to stand earlier too."""
    seen: set[bytes] = set()
    faults: list[str | None] = []
    for at, (role, text) in enumerate(zip(roles, texts)):
        end = text.rstrip(SPACES)
        key = row_key(role, text)
        if not end:
            faults.append("blank")
        elif at in repeated or key in seen:
            faults.append("duplicate")
        else:
            faults.append(None if end[-1] in ".!?" else "truncated")
        seen.add(key)
    return faults


def damaged(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, there: the rows after damage. A dropped row leaves one that is not there."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce(F.col("role"), space), F.coalesce(F.col("text"), space)
    there = kind != 0
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(kind == 4, "user").when(there, role).otherwise("").alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        there.alias("there"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


PARTS = "conv long, part long, whole boolean, turns array<long>, roles array<string>, texts array<string>"
COUNTS = ("blank", "duplicate", "truncated", "illegal")
FOUND = (
    "conv long, part long, n_parts long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, roles array<string>, texts array<string>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
_PARTS = pa.schema(
    [("conv", pa.int64()), ("part", pa.int64()), ("whole", pa.bool_()), ("turns", _LONGS), ("roles", _STRINGS), ("texts", _STRINGS)]
)
_FOUND = pa.schema(
    [(name, pa.int64()) for name in ("conv", "part", "n_parts", "gaps", *COUNTS, "cost")]
    + [("audit", pa.string()), ("roles", _STRINGS), ("texts", _STRINGS)]
)


def _cut(rows: int, size: int) -> Callable[[Rows], Rows]:
    """Parts of at most so many rows and bytes (or one row), in order; ``whole`` if all of a conversation is one part."""

    def compute(batches: Rows) -> Rows:
        number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
        held: list[tuple] = []
        used, now, begun, edge = 0, None, False, True  # the first conversation may have begun in the task before
        out: list[tuple] = []
        waiting = 0

        def part(whole: bool) -> tuple:
            nonlocal number, held, used
            turns, roles, texts = zip(*held) if held else ((), (), ())
            held, used, number = [], 0, number + 1
            return now, number - 1, whole, turns, roles, texts

        for batch in batches:
            for conv, turn, role, text, there in zip(*(column.to_pylist() for column in batch.columns)):
                if begun and conv != now:
                    out.append(part(not edge))
                    edge = False
                begun, now = True, conv
                if there:
                    more = len(role) + len(text)
                    if held and (len(held) >= rows or used + more > size):
                        out.append(part(False))
                        edge = True
                    held.append((turn, role, text))
                    used += more
                    waiting += more
                if out and (waiting > size or len(out) >= 1024):
                    yield _batch(out, _PARTS)
                    out, waiting = [], 0
        if begun:
            out.append(part(False))  # the last one may go on in the next task
        if out:
            yield _batch(out, _PARTS)

    return compute


def _turn_numbers(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    known = [turn for turn in turns if turn is not None]
    return (known[0], known[-1], len(set(known))) if known else (None, None, 0)


def _illegal(roles: list[str]) -> int:
    initials = [initial(role) for role in roles]
    return sum(pair not in LEGAL for pair in zip(initials, initials[1:]))


def _whole(batches: Rows) -> Rows:
    for batch in batches:
        rows = []
        for conv, part, _, turns, roles, texts in zip(*(column.to_pylist() for column in batch.columns)):
            low, high, distinct = _turn_numbers(turns)
            faults = faults_of(roles, texts, set())
            symbols = [symbol_of(role, fault) for role, fault in zip(roles, faults)]
            _, cost = costs_before(symbols, AT_END)
            audit, _ = audit_of(symbols, AT_END, 0, True)
            counts = [faults.count(name) for name in COUNTS[:3]]
            gaps = high - low + 1 - distinct if distinct else 0
            rows.append((conv, part, 1, gaps, *counts, _illegal(roles), cost, audit, *repaired(roles, texts, audit, 0)))
        if rows:
            yield _batch(rows, _FOUND)


def _keys(batches: Rows) -> Rows:
    """Conversation, part, place and key of the rows that could repeat others."""
    schema = pa.schema([("conv", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("key", pa.binary())])
    for batch in batches:
        for conv, part, _, _, roles, texts in zip(*(column.to_pylist() for column in batch.columns)):
            rows = [(conv, part, at, row_key(role, text)) for at, (role, text) in enumerate(zip(roles, texts)) if text.rstrip(SPACES)]
            if rows:
                yield _batch(rows, schema)


_CODED = pa.schema(
    [("conv", pa.int64()), ("part", pa.int64()), ("symbols", pa.binary()), ("matrix", _LONGS), ("low", pa.int64()), ("high", pa.int64())]
    + [("distinct", pa.int64()), ("first", pa.string()), ("last", pa.string()), *((name, pa.int64()) for name in COUNTS)]
)
CODED = (
    "conv long, part long, symbols binary, matrix array<long>, low long, high long, distinct long, first string, last string, "
    "blank long, duplicate long, truncated long, illegal long"
)


def _coded(batches: Rows) -> Rows:
    for batch in batches:
        rows = []
        for conv, part, turns, roles, texts, repeated in zip(*(column.to_pylist() for column in batch.columns)):
            faults = faults_of(roles, texts, set(repeated or ()))
            symbols = [symbol_of(role, fault) for role, fault in zip(roles, faults)]
            matrix = [cost for row in matrix_of(symbols) for cost in row]
            counts = [faults.count(name) for name in COUNTS[:3]]
            ends = (initial(roles[0]), initial(roles[-1])) if roles else (None, None)
            rows.append((conv, part, bytes(symbols), matrix, *_turn_numbers(turns), *ends, *counts, _illegal(roles)))
        if rows:
            yield _batch(rows, _CODED)


def _backward(batches: Rows) -> Rows:
    """From (conv, part, matrix) by conversation, last part first: the costs after each part, and whether it is the last."""
    schema = pa.schema([("part", pa.int64()), ("after", _LONGS), ("closing", pa.bool_()), ("cost", pa.int64())])
    now, after = object(), AT_END
    for batch in batches:
        rows = []
        for conv, part, matrix in zip(*(column.to_pylist() for column in batch.columns)):
            closing = conv != now
            if closing:
                now, after = conv, AT_END
            here = advance(tuple(tuple(matrix[4 * s : 4 * s + 4]) for s in STATES), after)
            rows.append((part, after, closing, here[0]))
            after = here
        if rows:
            yield _batch(rows, schema)


def _from_each_state(batches: Rows) -> Rows:
    """The audits of a part from each of the four states, and the states they end in."""
    schema = pa.schema([("part", pa.int64()), ("audits", _STRINGS), ("ends", _LONGS)])
    for batch in batches:
        rows = []
        for part, symbols, after, closing in zip(*(column.to_pylist() for column in batch.columns)):
            least = min(after)
            found = [audit_of(list(symbols), tuple(cost - least for cost in after), state, closing) for state in STATES]
            rows.append((part, [audit for audit, _ in found], [end for _, end in found]))
        if rows:
            yield _batch(rows, schema)


_WALKED = pa.schema([(name, pa.int64()) for name in ("conv", "part", "state", "n_parts", "gaps", *COUNTS, "cost")])


def _forward(batches: Rows) -> Rows:
    """By conversation in order of the parts: each part's state; the last part has the conversation's counts."""
    state, low, high, distinct, ending, total, n, all_of_it = 0, None, None, 0, None, [0] * 4, 0, 0
    for batch in batches:
        rows = []
        for conv, part, ends, closing, cost, first_turn, last_turn, turns, first, last, *counts in zip(*(c.to_pylist() for c in batch.columns)):
            if not n:
                all_of_it = cost
            n += 1
            rows.append([conv, part, state, None, None, None, None, None, None, None])
            state = ends[state]
            total = [one + other for one, other in zip(total, counts)]
            if first is not None:
                total[3] += ending is not None and (ending, first) not in LEGAL
                ending = last
            if turns:
                distinct += turns - (first_turn == high)
                low, high = first_turn if low is None else low, last_turn
            if closing:
                gaps = high - low + 1 - distinct if distinct else 0
                rows[-1][3:] = [n, gaps, *total, all_of_it]
                state, low, high, distinct, ending, total, n = 0, None, None, 0, None, [0] * 4, 0
        if rows:
            yield _batch(rows, _WALKED)


def _applied(batches: Rows) -> Rows:
    for batch in batches:
        rows = []
        for conv, part, roles, texts, audits, state, *numbers in zip(*(column.to_pylist() for column in batch.columns)):
            audit = audits[state]
            rows.append((conv, part, *numbers, audit, *repaired(roles, texts, audit, state)))
        if rows:
            yield _batch(rows, _FOUND)


def _joined(parts: DataFrame, scratch: Scratch) -> DataFrame:
    """What ``repair`` returns, for conversations that stretch over several parts."""
    keys = scratch.saved(parts.mapInArrow(_keys, "conv long, part long, place long, key binary"), "keys")
    place = F.struct("part", "place")
    firsts = keys.groupBy(F.coalesce("conv", F.lit(0)).alias("id"), F.col("conv").isNull().alias("none"), "key")
    firsts = firsts.agg(F.min(place).alias("least"), F.count("*").alias("n")).where("n > 1")
    same = keys.withColumns({"id": F.coalesce("conv", F.lit(0)), "none": F.col("conv").isNull()})
    later = same.join(firsts, ["id", "none", "key"]).where(place > F.col("least"))
    repeated = later.groupBy("part").agg(F.collect_list("place").alias("repeated"))  # at most a part's rows
    given = parts.join(repeated, "part", "left").select("conv", "part", "turns", "roles", "texts", "repeated")
    coded = scratch.saved(given.mapInArrow(_coded, CODED), "coded")
    ordered = coded.select("conv", "part", "matrix").repartition("conv").sortWithinPartitions("conv", F.desc("part"))
    costs = scratch.saved(ordered.mapInArrow(_backward, "part long, after array<long>, closing boolean, cost long"), "costs")
    four = coded.join(costs, "part").select("part", "symbols", "after", "closing")
    choices = scratch.saved(four.mapInArrow(_from_each_state, "part long, audits array<string>, ends array<long>"), "choices")
    numbers = coded.join(costs, "part").join(choices.select("part", "ends"), "part")
    numbers = numbers.select("conv", "part", "ends", "closing", "cost", "low", "high", "distinct", "first", "last", *COUNTS)
    walked = numbers.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(
        _forward, ", ".join(f"{name} long" for name in _WALKED.names)
    )
    walked = scratch.saved(walked.drop("conv"), "walked")
    rest = ["n_parts", "gaps", *COUNTS, "cost"]
    chosen = parts.join(choices, "part").join(walked, "part").select("conv", "part", "roles", "texts", "audits", "state", *rest)
    return chosen.mapInArrow(_applied, FOUND)


def _both(rows: DataFrame, part_rows: int, part_bytes: int) -> tuple[DataFrame, DataFrame]:
    scratch = Scratch(rows.sparkSession, "conversations")
    order = [F.asc_nulls_first(name) for name in ("conv", "turn", "role")]
    # Ranges by the start of a text only, as samples of the keys go to the driver.
    ranged = rows.select("conv", "turn", "role", "text", "there").repartitionByRange(*order, F.substring("text", 1, 32))
    ordered = ranged.sortWithinPartitions(*order, "text")
    parts = scratch.saved(ordered.mapInArrow(_cut(part_rows, part_bytes), PARTS), "parts")
    return parts.where("whole").mapInArrow(_whole, FOUND), _joined(parts.where("not whole"), scratch)


def repair(rows: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """conv, part, audit, roles, texts of every part of every repaired conversation, and the conversation's counts.

    ``rows`` has conv, turn, role, text and there (whether the row exists or only names its conversation). The
    conversation's numbers (n_parts, gaps, blank, duplicate, truncated, illegal, cost) stand with its last part and
    are NULL in the others; parts are in order of their numbers. Rows are taken by turn, NULLs first, equal turns by
    role and text. NULL ids are one conversation. Without any existing row all is empty and zero.
    """
    whole, joined = _both(rows, part_rows, part_bytes)
    return whole.unionByName(joined)


def _hashed(batches: Rows) -> Rows:
    """By conversation in order of the parts: the hash of all its lines, one part in memory."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string()), ("audit", pa.string()), *((n, pa.int64()) for n in ("gaps", *COUNTS, "cost"))])
    digest, begun, audits = hashlib.sha256(), False, []
    for batch in batches:
        rows = []
        for conv, roles, texts, audit, closing, *numbers in zip(*(column.to_pylist() for column in batch.columns)):
            for role, text in zip(roles, texts):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
            audits.append(audit)
            if closing is not None:
                rows.append((conv, digest.hexdigest(), "".join(audits), *numbers))
                digest, begun, audits = hashlib.sha256(), False, []
        if rows:
            yield _batch(rows, schema)


def audited(conversations: DataFrame, part_rows: int = PART_ROWS, part_bytes: int = PART_BYTES) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation damaged.

    Every conv_id of the table comes out once, NULL among them. NULL roles and texts are one space, so that such a
    text is blank and such a role none of the three. Repeated rows are duplicates. Further columns don't matter.
    """
    whole, joined = _both(damaged(conversations), part_rows, part_bytes)
    lines = F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text))
    numbers = ["gaps", *COUNTS, "cost"]
    digest = F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    one = whole.select(F.col("conv").alias("conv_id"), *numbers, "audit", digest)
    # A hash is one pass over its text, so the parts of a long conversation stream through one task, each as one row.
    several = joined.select("conv", "part", "roles", "texts", "audit", "n_parts", *numbers)
    several = several.repartition("conv").sortWithinPartitions("conv", "part").drop("part")
    longs = ", ".join(f"{name} long" for name in numbers)
    hashed = several.mapInArrow(_hashed, f"conv long, repaired_sha256 string, audit string, {longs}")
    return one.unionByName(hashed.withColumnRenamed("conv", "conv_id"))


AUDIT_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT *, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda ch: ascii(ch)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1)))) AS crc
  FROM conversations
), kinds AS (SELECT *, xor(crc, 4294967295) % 20 AS kind FROM keyed
), rows_ AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE r END AS role, CASE kind WHEN 1 THEN '' WHEN 2
    THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 AS again,
    regexp_replace(text, '[ \x09-\x0D]+$', '') AS body, left(role, 1) AS c
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS spot FROM rows_)
), coded AS (
  SELECT *, body = '' AS blank, again AND body <> '' AS repeated, body <> '' AND NOT again AND NOT regexp_matches(body, '[.!?]$') AS cut,
    lag(c) OVER (PARTITION BY conv_id ORDER BY spot) AS prior FROM placed
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (repeated) AS duplicate, count(*) FILTER (cut) AS truncated,
    count(*) FILTER (prior IS NOT NULL AND prior || c NOT IN ('su', 'ua', 'au')) AS illegal, max(spot) AS n
  FROM coded GROUP BY conv_id
), steps AS (  -- what can be done with a row from each state: K keep, R rename, D delete
  SELECT * FROM (VALUES (0, 2, 'u', 'user'), (1, 2, 'u', 'user'), (2, 3, 'a', 'assistant'), (3, 2, 'u', 'user')) AS v(s, e, i, name)
), more AS (  -- up to two insertions from a state
  SELECT s, s AS e, 0 AS cost, '' AS letters, [] AS added FROM steps
  UNION ALL SELECT s, e, 2, 'I', [name || ':'] FROM steps
  UNION ALL SELECT a.s, b.e, 4, 'II', [a.name || ':', b.name || ':'] FROM steps a JOIN steps b ON b.s = a.e
), walk AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS spot, 0 AS s, {'cost': 0, 'audit': '', 'lines': []::VARCHAR[]} AS best FROM conversations
  UNION ALL
  SELECT conv_id, spot, s, list_sort(list(best))[1] FROM (
    SELECT w.conv_id, c.spot, m.e AS mid, moved.e AS s, {'cost': (w.best.cost + m.cost + moved.cost)::INTEGER,
      'audit': w.best.audit || m.letters || moved.letter, 'lines': w.best.lines || m.added || moved.line} AS best
    FROM walk w JOIN coded c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.spot = w.spot + 1 JOIN more m ON m.s = w.s,
    LATERAL (
      SELECT m.e AS e, 3 AS cost, 'D' AS letter, []::VARCHAR[] AS line
      UNION ALL SELECT CASE WHEN c.c = 's' THEN 1 ELSE st.e END, CAST(c.cut AS INTEGER), 'K', [c.role || ':' || c.text]
        FROM steps st WHERE st.s = m.e AND NOT c.blank AND NOT c.repeated AND (st.i = c.c OR c.c = 's' AND m.e = 0)
      UNION ALL SELECT st.e, 2 + CAST(c.cut AS INTEGER), 'R', [st.name || ':' || c.text] FROM steps st
        WHERE st.s = m.e AND NOT c.blank AND NOT c.repeated
    ) moved
  ) GROUP BY conv_id, spot, s
), ended AS (
  SELECT w.conv_id, list_sort(list({'cost': w.best.cost + m.cost, 'audit': w.best.audit || m.letters, 'lines': w.best.lines || m.added}))[1] AS best
  FROM walk w LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM w.conv_id JOIN more m ON m.s = w.s AND m.e IN (0, 3)
  WHERE w.spot = coalesce(stats.n, 0) GROUP BY w.conv_id
)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost,
  e.best.audit AS audit, sha256(array_to_string(e.best.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM e.conv_id
"""
