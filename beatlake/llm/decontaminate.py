"""Benchmark decontamination with an Aho-Corasick automaton over the words of normalised benchmark items.

Texts are normalised byte by byte (ASCII letters lower-cased; everything but ASCII letters, digits and bytes of
other scripts is a space) to words, and words of the benchmark to numbers. A window of 13 words holds one of an item's
blocks of 7 words that begin at every seventh, wherever it begins. So one automaton over those blocks, with a node a
word of the benchmark, scans each text once, and each match is drawn out to both sides as far as text and item agree:
all windows in it occur. Matches are ranges of words, and words are mapped to offsets of the original text.

The benchmark's words go to every Python worker, which builds its automaton once. Beyond ``BLOCK_BYTES`` the items are
dealt into blocks of that size, one after the other on the driver, each with its own automaton and scan, and the
blocks' hits are united by document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from hashlib import sha256
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import free_name, numbered_rows, saved

WINDOW_WORDS = 13
BLOCK_BYTES = 16 << 20
CONTAMINATED_PART = 20
NORMAL = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if 48 <= byte <= 57 or 97 <= byte <= 122 or byte >= 128 else 32
    for byte in range(256)
)
Items = list[tuple[str, bytes]]


class Scanner:
    """The automaton of some items, and what it finds in a text."""

    def __init__(self, items: Items, width: int = WINDOW_WORDS) -> None:
        self.width, self.step = width, (width + 1) // 2
        self.numbers: dict[bytes, int] = {}
        # Items of equal words are one; each has the ids of all.
        ids: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            codes = [self.numbers.setdefault(word, len(self.numbers) + 1) for word in text.translate(NORMAL).split()]
            if codes:
                ids[np.array(codes, dtype=np.int32).tobytes()].add(item)
        self.words = [np.frombuffer(codes, dtype=np.int32) for codes in ids]
        self.ids = [tuple(sorted(own)) for own in ids.values()]
        places: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for item, words in enumerate(self.words):
            size = self.step if len(words) >= width else len(words)
            for at in range(0, len(words) - size + 1, size):
                places[tuple(words[at : at + size].tolist())].append((item, at))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for block, where in places.items():
            self.automaton.add_word(block, (len(block), where))
        self.empty = not places
        if places:
            self.automaton.make_automaton()

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges [first, end) covered by windows, merged and in order, and the items whose windows occur."""
        if self.empty or not words:
            return [], set()
        get = self.numbers.get
        codes = [get(word, 0) for word in words]
        spans: set[tuple[int, int]] = set()
        found: set[int] = set()
        done: dict[tuple[int, int], int] = {}  # how far the match of an item at a shift has been drawn out
        text = None
        for last, (size, where) in self.automaton.iter(tuple(codes)):
            begin = last - size + 1
            for item, at in where:
                own = self.words[item]
                if len(own) < self.width:
                    spans.add((begin, last + 1))
                    found.add(item)
                    continue
                if done.get((item, begin - at), -1) >= last:
                    continue
                text = np.array(codes, dtype=np.int32) if text is None else text
                before = min(begin, at)
                left = _agreeing(text[begin - before : begin][::-1], own[at - before : at][::-1])
                after = min(len(text) - last - 1, len(own) - at - size)
                right = _agreeing(text[last + 1 : last + 1 + after], own[at + size : at + size + after])
                done[item, begin - at] = last + right
                if left + size + right >= self.width:
                    spans.add((begin - left, last + 1 + right))
                    found.add(item)
        ranges: list[tuple[int, int]] = []
        for first, end in sorted(spans):
            if ranges and first <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(ranges[-1][1], end))
            else:
                ranges.append((first, end))
        return ranges, {name for item in found for name in self.ids[item]}


def _agreeing(one: np.ndarray, other: np.ndarray) -> int:
    """How many words two sequences begin with in common, looked at in growing steps."""
    at, step = 0, 16
    while at < len(one):
        unlike = np.flatnonzero(one[at : at + step] != other[at : at + step])
        if len(unlike):
            return at + int(unlike[0])
        at, step = at + step, 2 * step
    return len(one)


_SCANNERS: dict[str, Scanner] = {}


def _scanner(token: str, items: Callable[[], Items], width: int) -> Scanner:
    """The worker's automaton; of another block's it lets go first."""
    if token not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[token] = Scanner(items(), width)
    return _SCANNERS[token]


def original_spans(text: bytes, ranges: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of ranges of words."""
    ranges = list(ranges)
    if not ranges:
        return []
    word = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate(([0], word.astype(np.int8), [0])))
    begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return [(int(begins[first]), int(ends[end - 1])) for first, end in ranges]


def block_count(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Into how many blocks of bounded size the items have to be dealt; only their sizes are added up."""
    size = F.octet_length(F.coalesce("text", F.lit("")))
    total = benchmark.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    return max(1, -(-total // block_bytes))


def _items(benchmark: DataFrame, block: int, blocks: int) -> Items:
    rows = (
        benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        .select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        )
        .collect()
    )
    return [(row.item, bytes(row.text)) for row in rows]


SCHEMA = "doc_id long, n_words long, ranges array<struct<first:long,end:long>>, items array<string>, spans array<struct<begin:long,stop:long>>"
SPAN = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
RANGE = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(given: Broadcast, width: int, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    token = uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(token, lambda: given.value, width)
        for batch in batches:
            counts, ranges, found, spans = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or b""
                words = text.translate(NORMAL).split()
                hit, ids = scanner.hits(words)
                counts.append(len(words))
                ranges.append([{"first": a, "end": b} for a, b in hit])
                found.append(sorted(ids))
                spans.append([{"begin": a, "stop": b} for a, b in original_spans(text, hit)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(ranges, RANGE),
                    pa.array(found, pa.list_(pa.string())),
                    pa.array(spans, SPAN),
                ],
                names=[name, "n_words", "ranges", "items", "spans"],
            )

    return scan


def find_windows(
    documents: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """doc_id, n_words, ranges of words hit, items with occurring windows, and spans: byte offsets in the text.

    One row a document, without a shuffle where the benchmark fits one block; else rows are numbered in a
    written table and the blocks' findings meet by that number. A NULL or empty text has no words, a NULL or
    empty item no windows, a NULL item id counts as the empty string; repeated rows, repeated items and NULL
    document ids are judged like any other; no rows give no rows, no items no hits.
    """
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    blocks = block_count(benchmark, block_bytes)
    context = documents.sparkSession.sparkContext
    if blocks == 1:
        return source.mapInArrow(_scan(context.broadcast(_items(benchmark, 0, 1)), width, "doc_id"), SCHEMA)
    numbered = saved(source.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    scans = None
    for block in range(blocks):
        given = context.broadcast(_items(benchmark, block, blocks))  # at most a block is held by driver and workers
        found = numbered.select("row", "text").mapInArrow(_scan(given, width, "row"), SCHEMA.replace("doc_id", "row"))
        scan = saved(found if block == 0 else found.where(F.size("items") > 0), "decontaminate-block")
        given.destroy()
        scans = scan if scans is None else scans.unionByName(scan)
    united = scans.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("ranges")).alias("ranges"),  # a block adds at most a range a word of one text
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    return numbered.select("row", "doc_id").join(united, "row").drop("row")


def _hit_words(ranges: str = "ranges") -> Column:
    """Words in the union of the ranges, which may overlap after several blocks."""
    return F.expr(
        f"aggregate(array_sort({ranges}), named_struct('n', 0L, 'at', 0L), "
        "(done, x) -> named_struct('n', done.n + greatest(0L, x.end - greatest(x.first, done.at)), "
        "'at', greatest(done.at, x.end)), done -> done.n)"
    )


def judge(documents: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document, by ``find_windows``."""
    found = find_windows(documents, benchmark, **settings)
    counted = found.select("doc_id", "n_words", _hit_words().alias("n_hit"), "items")
    return counted.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (CONTAMINATED_PART * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **settings: int) -> DataFrame:
    """The documents that are not contaminated, with all their columns; each row is judged by its own text."""
    row = free_name("decontaminate_row", documents.columns)
    numbered = numbered_rows(documents, row, "decontaminate-documents")
    verdicts = judge(numbered.select(F.col(row).alias("doc_id"), "text"), benchmark, **settings)
    gone = saved(verdicts.where("contaminated").select(F.col("doc_id").alias(row)), "decontaminate-gone")
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{name}`") for name in documents.columns])


# Windows of words looked up by equality: every window of an item against every position of a document.
DECONTAMINATE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, array_to_string(w[place : place + 12], ' ') AS win, least(13, len(w)) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS place FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, place, n, array_to_string(w[place : place + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS place FROM words, sizes WHERE len(w) >= n)
), found AS (
  SELECT DISTINCT doc_id, place, places.n, item FROM places JOIN windows USING (win, n)
), hit AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(place, place + n)) AS spot FROM found) GROUP BY doc_id
), ids AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list_distinct(list(item))), ',') AS joined FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
