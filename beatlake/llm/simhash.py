"""Near-duplicate documents by SimHash, linked through a pigeonring index.

A fingerprint's 64 bits form a ring of eight segments. If two fingerprints differ in at most three bits, the
chain that starts at some segment has, for every length n, at most floor(3 n / 8) differing bits in its first n
segments. So its first two segments are equal, and of the next three, which differ in one bit at most, one half
is equal too: 16 + 12 equal bits, at 8 starts and 2 halves, find every pair. Candidates of a key are checked
chain length by chain length, shortest first, and the last length is the full Hamming check.

Only distinct fingerprints are linked, and a key's members are searched component by component instead of pair
by pair: a member leaves the search as soon as it is reached, and one link a member comes out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from beatlake.llm.common import LOWER_ASCII, free_name, numbered_rows, saved, words_of

SHINGLE_WORDS = 3
SEED = 42
BITS, SEGMENTS, THRESHOLD = 64, 8, 3
BUDGETS = np.arange(1, SEGMENTS + 1) * THRESHOLD // SEGMENTS
BLOCK_ROWS = 4096
CHUNK = 1 << 15


def fingerprint(text: bytes | None, width: int = SHINGLE_WORDS) -> int:
    """The unsigned SimHash of all word shingles; fewer words are one shingle, no words give zero."""
    words = words_of((text or b"").translate(LOWER_ASCII))
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(word) + 1 for word in words)))
    starts = [0, *ends[:-1]]
    last = ends[width - 1 :] or ends[-1:]
    total = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(last), CHUNK):
        hashes = np.array(
            [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts[at : at + CHUNK], last[at : at + CHUNK])],
            dtype=">u8",
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > len(last)).tobytes(), "big")


def fingerprints(documents: DataFrame, row: str = "doc_id", width: int = SHINGLE_WORDS) -> DataFrame:
    """The row column and fp (the fingerprint's bits as a long) of every document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text.as_py(), width) for text in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["row", "fp"])

    source = documents.select(F.col(row).cast("long").alias("row"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(compute, "row long, fp long")


def chained(differences: np.ndarray, start: int) -> np.ndarray:
    """Which differing-bit patterns keep within the budget of every chain length from segment ``start``."""
    within = np.ones(len(differences), dtype=bool)
    segments = differences.astype(">u8").view(np.uint8).reshape(-1, SEGMENTS)
    spent = np.zeros(len(differences), dtype=np.int64)
    for length in range(SEGMENTS):
        spent = spent + np.bitwise_count(segments[:, (start + length) % SEGMENTS])
        within &= spent <= BUDGETS[length]
        if not within.any():
            break
    return within


def links_of(members: np.ndarray, start: int) -> list[tuple[int, int]]:
    """(member, least member it is connected to) for every member of a key but the least of each component."""
    if len(members) == 2:  # most keys
        return [(int(members[1]), int(members[0]))] if chained(members[:1] ^ members[1:], start)[0] else []
    links = []
    left = np.unique(members)
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = chained(left ^ front.pop(), start)
            if near.any():
                found = left[near]
                links += [(int(member), int(root)) for member in found]
                front.extend(found)
                left = left[~near]
    return links


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, fp) in order of key and part; a key and part is held whole, two blocks at most."""
    held, held_key = [], None

    def flush() -> list[tuple[int, int]]:
        members = np.concatenate(held) if held else np.empty(0, dtype=np.uint64)
        return links_of(members, (held_key[0] >> 29) & 7) if len(members) > 1 else []

    for batch in batches:
        key, part, prints = (batch.column(at).to_numpy() for at in range(3))
        prints = prints.view(np.uint64)
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (part[1:] != part[:-1])) + 1
        links: list[tuple[int, int]] = []
        begins, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(key)]
        for begin, end in zip(begins, ends):
            if begin == end:
                continue
            now = (int(key[begin]), int(part[begin]))
            if now != held_key:
                links += flush()
                held, held_key = [], now
            held.append(prints[begin:end])
        if links:
            yield pa.RecordBatch.from_arrays([_signed([a for a, _ in links]), _signed([b for _, b in links])], names=["a", "b"])
    links = flush()
    if links:
        yield pa.RecordBatch.from_arrays([_signed([a for a, _ in links]), _signed([b for _, b in links])], names=["a", "b"])


def keyed(distinct: DataFrame) -> DataFrame:
    """16 keys a fingerprint: start (3 bits), half (1), 16 equal bits, 12 equal bits."""
    keys = []
    for start in range(SEGMENTS):
        turn = 8 * start
        ring = f"(shiftleft(fp, {turn}) | shiftrightunsigned(fp, {64 - turn}))" if turn else "fp"
        for half in (0, 1):
            equal = f"(shiftrightunsigned({ring}, 48) * 4096 + (shiftrightunsigned({ring}, {36 - 12 * half}) & 4095L))"
            keys.append(f"{(start * 2 + half) << 28}L + {equal}")
    return distinct.select(F.explode(F.expr(f"array({', '.join(keys)})")).alias("key"), "fp")


def links(distinct: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """a, b (longs): links between distinct fingerprints that connect all that differ in three bits or fewer.

    Keys with more members than ``block_rows`` are dealt into blocks, and every two blocks meet in a task of
    their own, so that nothing is left out and no task holds more than two blocks.
    """
    rows = keyed(distinct)
    large = saved(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block_rows), "simhash-large")
    parted = rows.withColumn("part", F.lit(0).cast("long"))
    if not large.isEmpty():
        blocks = F.ceil(F.col("n") / (block_rows // 2 + 1)).cast("long")
        dealt = (
            rows.join(large.select("key", blocks.alias("blocks")), "key", "left")
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)))
        )
        parted = dealt.select(
            "key", "fp", (F.least("own", "other") * F.coalesce("blocks", F.lit(1)) + F.greatest("own", "other")).alias("part")
        )
    ordered = parted.select("key", "part", "fp").repartition("key", "part").sortWithinPartitions("key", "part")
    return ordered.mapInArrow(_search, "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """fp, root (the least fp it is connected to) of every fp that has a link.

    Every round joins each neighbour of a node to the node's least neighbour, which halves distances and ends
    with stars. Each round is a written table, so neither lineage nor a lost executor grows it.
    """
    state = None
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "simhash-links")
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(now) == state:
            return edges.select(F.col("a").alias("fp"), F.col("b").alias("root"))
        state = tuple(now)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "simhash-least")
        moved = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "simhash-round")


def groups(rows: DataFrame) -> DataFrame:
    """fp, root of every distinct fingerprint of rows (row, fp): equal roots are one group of documents."""
    distinct = saved(rows.select("fp").distinct(), "simhash-distinct")
    joined = distinct.join(connected(links(distinct)), "fp", "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """A row a document: doc_id, fingerprint (16 hex digits), component_id (least doc_id of its group).

    NULL and empty texts have fingerprint zero and are linked like any other. Repeated rows and ids come out as
    often as they go in; a group without any id has a NULL component. No rows give no rows; further columns
    don't matter.
    """
    rows = saved(fingerprints(documents), "simhash-fingerprints")
    rooted = saved(groups(rows), "simhash-groups")
    least = rows.groupBy("fp").agg(F.min("row").alias("least"))
    by_root = saved(rooted.join(least, "fp"), "simhash-least-ids")
    components = by_root.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(by_root.select("fp", "root").join(components, "root").select("fp", "component_id"), "simhash-components")
    return rows.join(named, "fp").select(
        F.col("row").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One document of each group, that with the least id (NULL last; of repeated rows one), with its columns."""
    row = free_name("simhash_row", documents.columns)
    numbered = numbered_rows(documents, row, "simhash-documents")
    rows = saved(fingerprints(numbered.select(row, "text"), row), "simhash-fingerprints")
    ids = numbered.select(F.col(row).alias("row"), F.col("doc_id"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    least = saved(rows.join(ids, "row").groupBy("fp").agg(F.min(order).alias("first")), "simhash-firsts")
    kept = least.join(saved(groups(rows), "simhash-groups"), "fp").groupBy("root").agg(F.min("first").alias("first"))
    chosen = saved(kept.select(F.col("first.row").alias(row)), "simhash-kept")
    return numbered.join(chosen, row, "left_semi").select(*[F.col(f"`{name}`") for name in documents.columns])
