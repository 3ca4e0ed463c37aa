"""Ranked lexical search: all documents scored for every item by dense blocked matrix products.

Items are taken in blocks of bounded text. A block's items form tiles of at most 128, and a tile's terms get compact
numbers of their own, so that both matrices of a product are dense and small: weights (terms x items) and impacts
(documents x terms). Weights and impacts are whole numbers. Terms are dealt over vocabulary tiles so that no product's
sum can reach 2^53, so float64 gives it exactly whatever the order of additions; sums over tiles are 64-bit integers.

A task keeps the best documents an item, all ties of the last one included until ids decide, and sends no more than
that to the final ranking. Documents are read twice a block: once for counts, once for scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatlake.llm.common import saved

TOP = 20
BLOCK_BYTES = 4 << 20  # of item texts at a time: what the driver and each Python worker hold grows with this alone
ITEM_TILE = 128
TERM_TILE = 2048
DOCUMENT_TILE = 256
PIECE = 1 << 20
SHARDS = 64
EXACT = 1 << 53
SCALE = 1_000_000_000
IMPACT_BELOW = 1_000_000  # tf / (1000 tf + 12 m) stays below 1/1000
NO_ID = np.iinfo(np.int64).max

# Letters and digits of ASCII and all other characters are terms; only A-Z change.
TERMS = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256)
)

Rows = Iterator[pa.RecordBatch]


def term_lists(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in lists of bounded size; no term is cut."""
    plain = (text or b"").translate(TERMS)
    begin = 0
    while begin < len(plain):
        end = plain.find(b" ", begin + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[begin:end].split()
        begin = end


def counted(text: bytes | None, codes: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text, and which of the coded terms occur in it how often."""
    n, found = 0, []
    for terms in term_lists(text):
        n += len(terms)
        hits = np.fromiter(map(codes.get, terms, repeat(-1)), dtype=np.int64, count=len(terms))
        found.append(hits[hits >= 0])
    joined = found[0] if len(found) == 1 else np.concatenate(found) if found else np.empty(0, dtype=np.int64)
    return n, *np.unique(joined, return_counts=True)


@dataclass(frozen=True)
class Tile:
    """Some items, and for every vocabulary tile its term codes and the weights (terms x items)."""

    items: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def _parts(codes: list[int], weights: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of weights in tiles whose products stay exact; a weight too great for that stands in several of them."""
    most = (EXACT - 1) // IMPACT_BELOW
    held, held_codes, total = [], [], np.zeros(weights.shape[1], dtype=np.int64)
    for code, row in zip(codes, weights):
        while row.any():
            now = np.minimum(row, most)
            if held and (len(held) == TERM_TILE or (total + now > most).any() or held_codes[-1] == code):
                yield np.array(held_codes), np.array(held, dtype=np.float64)
                held, held_codes, total = [], [], np.zeros_like(total)
            held.append(now)
            held_codes.append(code)
            total = total + now
            row = row - now
    if held:
        yield np.array(held_codes), np.array(held, dtype=np.float64)


def tiles_of(wanted: dict[int, dict[int, int]], weight: np.ndarray) -> list[Tile]:
    """Tiles of the items (item: code: occurrences), items with many common terms not brought together."""
    tiles, ordered = [], sorted(wanted)
    for at in range(0, len(ordered), ITEM_TILE):
        items = ordered[at : at + ITEM_TILE]
        codes = sorted({code for item in items for code in wanted[item]})
        place = {code: n for n, code in enumerate(codes)}
        weights = np.zeros((len(codes), len(items)), dtype=np.int64)
        for column, item in enumerate(items):
            for code, times in wanted[item].items():
                weights[place[code], column] = times * int(weight[code])
        tiles.append(Tile(np.array(items, dtype=np.int64), list(_parts(codes, weights))))
    return tiles


class Best:
    """The best documents of each item of a tile so far, equal scores by the lesser id."""

    def __init__(self, items: int, top: int) -> None:
        self.top = top
        self.least = np.ones(items, dtype=np.int64)  # a score has to be above 0
        self.held: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of (documents x items); what equals an item's last score stays until ids decide."""
        rows, columns = np.nonzero(scores >= self.least)
        if len(rows):
            self.held.append((columns, scores[rows, columns], ids[rows]))
            self.waiting += len(rows)
            if self.waiting > 8 * self.top * len(self.least):
                self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Item, score and id of the best, and no more."""
        if not self.held:
            return (np.empty(0, dtype=np.int64),) * 3
        items, scores, ids = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, -scores, items))
        items, scores, ids = items[order], scores[order], ids[order]
        rank = np.arange(len(items)) - np.searchsorted(items, items)
        keep = rank < self.top
        last = rank == self.top - 1
        self.least[items[last]] = scores[last]
        self.held = [(items[keep], scores[keep], ids[keep])]
        self.waiting = 0
        return self.held[0]


def impacts(documents: list[tuple[int, np.ndarray, np.ndarray]], codes: np.ndarray, n: int, length: int) -> np.ndarray:
    """What one occurrence in an item is worth of each term (columns) in each document (rows), in whole numbers."""
    out = np.zeros((len(documents), len(codes)))
    for row, (terms, found, times) in enumerate(documents):
        at = np.searchsorted(codes, found)
        here = at < len(codes)
        here[here] = codes[at[here]] == found[here]
        tf = times[here].astype(np.int64)
        m = 75 + 25 * terms * n // length
        out[row, at[here]] = SCALE * tf // (1000 * tf + 12 * m)
    return out


def _counts(codes: dict[bytes, int]) -> Callable[[Rows], Rows]:
    """Per task: how many documents hold a term, code by code; -1 documents with any term, -2 terms."""

    def compute(batches: Rows) -> Rows:
        holding = np.zeros(len(codes), dtype=np.int64)
        documents = length = 0
        for batch in batches:
            for text in batch.column(0):
                n, found, _ = counted(text.as_py(), codes)
                documents += n > 0
                length += n
                holding[found] += 1
        used = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, -2, *used.tolist()], pa.int64()), pa.array([documents, length, *holding[used].tolist()], pa.int64())],
            names=["code", "n"],
        )

    return compute


def _scores(codes: dict[bytes, int], tiles: list[Tile], n: int, length: int, top: int) -> Callable[[Rows], Rows]:
    def compute(batches: Rows) -> Rows:
        best = [Best(len(tile.items), top) for tile in tiles]
        ids: list[int] = []
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []

        def multiply() -> None:
            names = np.array(ids, dtype=np.int64)
            for tile, kept in zip(tiles, best):
                scores = np.zeros((len(waiting), len(tile.items)), dtype=np.int64)
                for part, weights in tile.parts:
                    scores += (impacts(waiting, part, n, length) @ weights).astype(np.int64)
                kept.add(names, scores)
            ids.clear()
            waiting.clear()

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = counted(text.as_py(), codes)
                if len(found[1]):
                    ids.append(NO_ID if name is None else name)
                    waiting.append(found)
                    if len(waiting) == DOCUMENT_TILE:
                        multiply()
        multiply()
        for tile, kept in zip(tiles, best):
            items, scores, names = kept.settle()
            columns = [pa.array(tile.items[items]), pa.array(names, mask=names == NO_ID), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return compute


def _item_terms(batches: Rows) -> Rows:
    """Item, term and how often it occurs in the item's text."""
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            times: dict[bytes, int] = {}
            for terms in term_lists(text.as_py()):
                for term in terms:
                    times[term] = times.get(term, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(times), pa.int64()), pa.array(list(times), pa.binary()), pa.array(list(times.values()), pa.int64())],
                names=["item", "term", "n"],
            )


def _search_block(texts: DataFrame, items: DataFrame, top: int) -> DataFrame | None:
    """item, doc_id, score: the best documents of each task for the items of one block."""
    codes: dict[bytes, int] = {}
    wanted: dict[int, dict[int, int]] = {}
    for row in items.select("item", F.col("text").cast("binary")).mapInArrow(_item_terms, "item long, term binary, n long").collect():
        wanted.setdefault(row.item, {})[codes.setdefault(bytes(row.term), len(codes))] = row.n
    counts = texts.select("text").mapInArrow(_counts(codes), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    held = {row.code: row.n for row in counts.collect()}  # a row a term of the block
    n, length = held.get(-1, 0), held.get(-2, 0)
    if not n or not codes:
        return None
    weight = np.array([floor(1000 * log((2 * n + 2) / (2 * held.get(code, 0) + 1))) for code in range(len(codes))], dtype=np.int64)
    found = texts.mapInArrow(_scores(codes, tiles_of(wanted, weight), n, length, top), "item long, doc_id long, score long")
    return saved(found, "lexical-block")


def search(documents: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of each item's best documents with a score above 0.

    A NULL or empty text has no term, so that such an item finds nothing and such a document is never found. Every
    row of ``items`` is an item, so that repeated rows give repeated results; every row of ``documents`` can be found,
    NULL ids last among equal scores. No rows on either side give no rows. Further columns don't matter. An item's
    own terms have to fit into a task's memory; the number of items doesn't matter.
    """
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", F.col("text").cast("string").alias("text"))
    numbered = saved(numbered, "lexical-items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = ceil(2 * size / block_bytes)  # about half a block each, as they are dealt by chance
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = []
    for block in range(blocks):
        part = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        found.append(_search_block(texts, part, top))
    found = [frame for frame in found if frame is not None]
    if not found:
        empty = numbered.limit(0)
        return empty.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # First among the tasks of a shard, so that no single task ranks what all tasks send for an item.
    rows = reduce(DataFrame.unionByName, found).withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)))
    first = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", "shard").orderBy(*order))).where(F.col("rank") <= top)
    last = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return last.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


RANKED_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms FROM documents WHERE text IS NOT NULL
), sized AS (
  SELECT doc, doc_id, terms, len(terms)::HUGEINT AS n FROM docs WHERE len(terms) > 0
), total AS (SELECT count(*)::HUGEINT AS big_n, sum(n)::HUGEINT AS big_l FROM sized
), asked AS (
  SELECT item, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark
  ) GROUP BY ALL
), vocabulary AS (SELECT DISTINCT term FROM asked
), tfs AS (
  SELECT doc, doc_id, n, term, count(*) AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM sized)
  JOIN vocabulary USING (term) GROUP BY ALL
), weighted AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tfs GROUP BY term), total
), scored AS (
  SELECT item, item_id, doc, doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS score
  FROM tfs JOIN asked USING (term) JOIN weighted USING (term), total GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 20
"""
