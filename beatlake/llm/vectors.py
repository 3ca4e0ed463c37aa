"""Near-duplicate embeddings by an epsilon grid order join.

Cosine 0.9 between unit vectors is a distance of at most epsilon. Vectors are sorted by their grid cells of side
epsilon on the leading principal directions (fitted on a bounded sample; they decide what can be skipped, never what
is linked). The sorted sequence is cut into blocks, blocks into tiles of bounded size. Two intervals of the sequence
are joined recursively: if the boxes around them are farther apart than epsilon, nothing in them can be linked and
the pair is skipped; else the halves are joined, down to two blocks, whose cosines are one matrix product. Spark
recurses down to pairs of tiles, and the task of a pair of tiles down to blocks.

A box spans the leading coordinates and the length of what they leave out, so its distance is a lower bound in all
dimensions. Equal vectors are one class. A task sends how many vectors each class is linked to and one link a class,
so a group of thousands of near copies costs no list of pairs. Products run in single precision first; whatever comes
within its error of the limit is computed again in double precision, which alone decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from xxhash import xxh3_128_digest

from beatlake.llm.common import Scratch, lowest
from beatlake.llm.simhash import connected

COSINE = 0.9
DIMENSIONS = 16
SAMPLE_ROWS, SAMPLE_SIZE = 4096, 8 << 20  # vectors and bytes that the principal directions are fitted on
BLOCK_ROWS = 512
TILE_BYTES = 32 << 20
TILES = 8
FAN = 8
SLACK = 1e-9

Rows = Iterator[pa.RecordBatch]


def _hashed(kind: str) -> Callable[[Rows], Rows]:
    """vec_id, digest, size and bytes of every vector; only vec_id for those without a direction."""

    def compute(batches: Rows) -> Rows:
        for batch in batches:
            digests, sizes, data = [], [], []
            lists = batch.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
            for begin, end in zip([0, *ends[:-1].tolist()], ends.tolist()):
                vector = values[begin:end] + 0.0  # no negative zeros
                if np.isfinite(vector).all() and vector.any():
                    data.append(vector.astype(kind).tobytes())
                    digests.append(xxh3_128_digest(vector.tobytes()))
                    sizes.append(len(vector))
                else:
                    for column in (digests, sizes, data):
                        column.append(None)
            columns = [batch.column(0), pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "digest", "size", "data"])

    return compute


def units(data: list[bytes] | bytes, size: int, kind: str) -> np.ndarray:
    """Vectors of length one in double precision; large and small components neither overflow nor vanish."""
    whole = data if isinstance(data, bytes) else b"".join(data)
    found = np.frombuffer(whole, kind).reshape(-1, size).astype(np.float64)
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.sqrt((found * found).sum(axis=1, keepdims=True))


def directions(sample: np.ndarray) -> np.ndarray:
    """The leading principal directions, as columns."""
    centred = sample - sample.mean(axis=0)
    _, found = np.linalg.eigh(centred.T @ centred)
    return np.ascontiguousarray(found[:, ::-1][:, :DIMENSIONS])


def coordinates(vectors: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates, and the length of the rest."""
    leading = vectors @ axes
    rest = np.sqrt(np.maximum(0, 1 - (leading * leading).sum(axis=1)))
    return np.column_stack([leading, rest])


def _placed(axes: np.ndarray, size: int, kind: str, side: float) -> Callable[[Rows], Rows]:
    def compute(batches: Rows) -> Rows:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(units(batch.column(2).to_pylist(), size, kind) @ axes / side).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cells.tolist(), pa.list_(pa.int32())), *batch.columns], names=["cells", "name", "n", "data"])

    return compute


BLOCKS = "task long, begin long, rows long, names binary, counts binary, data binary, low array<double>, high array<double>"


def _packed(axes: np.ndarray, size: int, kind: str, block_rows: int) -> Callable[[Rows], Rows]:
    """Blocks of rows (name, n, data) in the order they come, with the box around each."""

    def compute(batches: Rows) -> Rows:
        task, begin = TaskContext.get().partitionId(), 0
        held: list[tuple[int, int, bytes]] = []

        def block() -> pa.RecordBatch:
            nonlocal begin
            names, counts, data = zip(*held)
            spots = coordinates(units(list(data), size, kind), axes)
            packed = [np.array(x, dtype=np.int64).tobytes() for x in (names, counts)]
            row = [task, begin, len(held), *packed, b"".join(data), spots.min(axis=0).tolist(), spots.max(axis=0).tolist()]
            begin += len(held)
            kinds = [pa.int64()] * 3 + [pa.binary()] * 3 + [pa.list_(pa.float64())] * 2
            names = ["task", "begin", "rows", "names", "counts", "data", "low", "high"]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                held.append(row)
                if len(held) == block_rows:
                    yield block()
                    held.clear()
        if held:
            yield block()

    return compute


class Block:
    def __init__(self, names: bytes, counts: bytes, data: bytes, low: list, high: list, size: int, kind: str) -> None:
        self.names, self.counts = np.frombuffer(names, np.int64), np.frombuffer(counts, np.int64)
        self.data, self.size, self.kind = data, size, kind
        self.low, self.high = np.array(low), np.array(high)
        self.single = units(data, size, kind).astype(np.float32)
        self.nodes = np.empty(0, dtype=np.int64)

    def double(self) -> np.ndarray:
        return units(self.data, self.size, self.kind)


def apart(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> float:
    """The squared distance of two boxes."""
    gaps = np.maximum(0, np.maximum(low - other_high, other_low - high))
    return float((gaps * gaps).sum())


class TileJoin:
    """The links between two tiles (or inside one): links of each node, and a forest that connects the same nodes."""

    def __init__(self, cosine: float) -> None:
        self.cosine = cosine
        self.epsilon = 2 - 2 * cosine + SLACK
        self.names: list[np.ndarray] = []
        self.count = 0
        self.links = np.empty(0, dtype=np.int64)
        self.parent = np.empty(0, dtype=np.int64)
        self.products = 0

    def admit(self, block: Block) -> None:
        block.nodes = np.arange(self.count, self.count + len(block.names))
        self.count += len(block.names)
        self.names.append(block.names)
        if self.count > len(self.parent):
            more = max(len(block.names), len(self.parent))
            self.parent = np.concatenate([self.parent, np.arange(len(self.parent), len(self.parent) + more)])
            self.links = np.concatenate([self.links, np.zeros(more, dtype=np.int64)])

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while (higher := self.parent[found]).tobytes() != found.tobytes():
            found = higher
        self.parent[nodes] = found
        return found

    def blocks(self, one: Block, other: Block) -> None:
        """All links between two blocks, or inside one."""
        self.products += 1
        error = 4e-7 * (one.size + 16) ** 0.5 + 1.2e-7 * one.size  # of products of single precision, generously
        if (one.single @ other.single.T).max() < self.cosine - error:
            return
        linked = one.double() @ other.double().T >= self.cosine
        if one is other:
            np.fill_diagonal(linked, False)
        rows, columns = np.flatnonzero(linked.any(axis=1)), np.flatnonzero(linked.any(axis=0))
        if not len(rows):
            return
        self.links[one.nodes] += linked @ other.counts
        if one is not other:
            self.links[other.nodes] += one.counts @ linked
        self.unite(one.nodes[rows], other.nodes[columns], linked[np.ix_(rows, columns)])

    def unite(self, nodes: np.ndarray, others: np.ndarray, linked: np.ndarray) -> None:
        """Joins the trees of linked nodes: least roots spread over the links until nothing changes."""
        old, old_other = self.roots(nodes), self.roots(others)
        if old.min() == max(old.max(), old_other.max()) == old_other.min():
            return
        now, now_other = old, old_other
        far = np.int64(self.count)
        while True:
            next_now = np.minimum(now, np.where(linked, now_other, far).min(axis=1))
            next_other = np.minimum(now_other, np.where(linked.T, next_now, far).min(axis=1))
            if (next_now == now).all() and (next_other == now_other).all():
                break
            now, now_other = next_now, next_other
        pairs = np.unique(np.column_stack([np.concatenate([old, old_other]), np.concatenate([now, now_other])]), axis=0)
        for a, b in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
            a, b = (int(self.roots(np.array([x]))[0]) for x in (a, b))
            self.parent[max(a, b)] = min(a, b)

    def intervals(self, one: list[Block], other: list[Block]) -> None:
        """Joins two intervals of a sequence, the same one or disjoint ones."""
        low, high, other_low, other_high = (
            f([getattr(x, name) for x in blocks], axis=0) for blocks in (one, other) for f, name in ((np.min, "low"), (np.max, "high"))
        )
        if apart(low, high, other_low, other_high) > self.epsilon:
            return
        if len(one) == len(other) == 1:
            self.blocks(one[0], other[0])
        elif one[0] is other[0] and len(one) == len(other):
            middle = len(one) // 2
            self.intervals(one[:middle], one[:middle])
            self.intervals(one[:middle], one[middle:])
            self.intervals(one[middle:], one[middle:])
        elif len(one) >= len(other):
            middle = len(one) // 2
            self.intervals(one[:middle], other)
            self.intervals(one[middle:], other)
        else:
            middle = len(other) // 2
            self.intervals(one, other[:middle])
            self.intervals(one, other[middle:])

    def found(self) -> pa.RecordBatch:
        names = np.concatenate(self.names)
        nodes = np.flatnonzero(self.links[: self.count])
        columns = [names[nodes], self.links[nodes], names[self.roots(nodes)]]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["name", "links", "root"])


def _tile_pairs(size: int, kind: str, cosine: float) -> Callable[[Rows], Rows]:
    """Rows (a, b, side, names, counts, data, low, high) in order of pair, side and sequence: side 0 is held whole."""

    def compute(batches: Rows) -> Rows:
        now, join, held = None, None, []

        def finish() -> pa.RecordBatch:
            if now[0] == now[1]:
                join.intervals(held, held)
            return join.found()

        for batch in batches:
            for a, b, side, *rest in zip(*(column.to_pylist() for column in batch.columns)):
                if (a, b) != now:
                    if now is not None:
                        yield finish()
                    now, join, held = (a, b), TileJoin(cosine), []
                block = Block(*rest, size, kind)
                join.admit(block)
                if side == 0:
                    held.append(block)
                else:
                    join.intervals(held, [block])
        if now is not None:
            yield finish()

    return compute


def _boxes(rows: DataFrame, name: Column, width: int) -> DataFrame:
    """The box around all rows of a name, with the interval of the next level that it belongs to."""
    lows = [F.min(F.col("low")[at]).alias(f"low{at}") for at in range(width)]
    highs = [F.max(F.col("high")[at]).alias(f"high{at}") for at in range(width)]
    boxes = rows.groupBy(name.alias("id")).agg(*lows, *highs)
    low, high = (F.array(*(F.col(f"{end}{at}") for at in range(width))).alias(end) for end in ("low", "high"))
    return boxes.select("id", F.floor(F.col("id") / FAN).alias("up"), low, high)


def _near_tiles(tiled: DataFrame, tiles: int, width: int, epsilon: float, scratch: Scratch) -> DataFrame:
    """a, b (a <= b): the pairs of tiles whose boxes are not too far apart, by recursion over intervals of tiles."""
    levels = [scratch.saved(_boxes(tiled, F.col("tile"), width), "boxes")]
    while (tiles := ceil(tiles / FAN)) > 1:
        levels.append(scratch.saved(_boxes(levels[-1], F.col("up"), width), f"boxes-{len(levels)}"))
    pairs = tiled.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    one_gap = F.zip_with("a_low", "b_high", lambda x, y: x - y)
    other_gap = F.zip_with("b_low", "a_high", lambda x, y: x - y)
    squares = F.zip_with(one_gap, other_gap, lambda x, y: F.pow(F.greatest(x, y, F.lit(0.0)), F.lit(2.0)))
    gap = F.aggregate(squares, F.lit(0.0), lambda total, x: total + x)
    for level, boxes in reversed(list(enumerate(levels))):
        sides = [boxes.select(*(F.col(name).alias(f"{side}_{name}") for name in boxes.columns)) for side in "ab"]
        met = pairs.join(sides[0], F.col("a") == F.col("a_up")).join(sides[1], F.col("b") == F.col("b_up"))
        near = met.where((F.col("a_id") <= F.col("b_id")) & (gap <= epsilon * epsilon + SLACK))
        pairs = scratch.saved(near.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")), f"near-{level}")
    return pairs


def _links(classes: DataFrame, size: int, kind: str, cosine: float, block_rows: int, tile_rows: int | None, scratch: Scratch) -> DataFrame:
    """name, links, root a pair of tiles and class that is linked in it, for classes (name, n, data) of one size."""
    epsilon = sqrt(2 - 2 * cosine)
    limit = max(1, min(SAMPLE_ROWS, SAMPLE_SIZE // (8 * size)))
    sample = lowest(classes.withColumn("turn", F.xxhash64("data")), limit, "name")
    axes = directions(units([bytes(row.data) for row in sample], size, kind))
    placed = classes.select("name", "n", "data").mapInArrow(_placed(axes, size, kind, epsilon), "cells array<int>, name long, n long, data binary")
    ordered = placed.repartitionByRange("cells", "name").sortWithinPartitions("cells", "name").select("name", "n", "data")
    blocks = scratch.saved(ordered.mapInArrow(_packed(axes, size, kind, block_rows), BLOCKS), f"blocks-{size}")
    # One number a task comes to the driver: where its rows begin in the whole sequence.
    offsets, total = [], 0
    for row in blocks.groupBy("task").agg(F.sum("rows").alias("rows")).orderBy("task").collect():
        offsets.append((row.task, total))
        total += row.rows
    if tile_rows is None:
        tile_rows = max(1, min(TILE_BYTES // (size * np.dtype(kind).itemsize), max(block_rows, ceil(total / TILES))))
    starts = blocks.sparkSession.createDataFrame(offsets, "task long, offset long")
    tiled = blocks.join(starts, "task").withColumn("at", F.col("offset") + F.col("begin"))
    tiled = tiled.withColumn("tile", F.floor(F.col("at") / tile_rows))
    pairs = _near_tiles(tiled, total // tile_rows + 1, axes.shape[1] + 1, epsilon, scratch)
    given = tiled.select("tile", "at", "names", "counts", "data", "low", "high")
    first = pairs.join(given, F.col("a") == F.col("tile")).withColumn("side", F.lit(0))
    second = pairs.where("a < b").join(given, F.col("b") == F.col("tile")).withColumn("side", F.lit(1))
    # A task's work is the products, not the bytes it reads, so partitions are not to be brought together by size.
    dealt = first.unionByName(second).repartition(max(1, min(pairs.count(), 20_000)), "a", "b")
    dealt = dealt.sortWithinPartitions("a", "b", "side", "at").select("a", "b", "side", "names", "counts", "data", "low", "high")
    return dealt.mapInArrow(_tile_pairs(size, kind, cosine), "name long, links long, root long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, block_rows: int = BLOCK_ROWS, tile_rows: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    ``n_links`` counts all other rows whose vector has a cosine of ``cosine`` or more, copies and repeated rows
    included. ``component_id`` is the least vec_id of all rows reachable by links (NULL if none of them has an id),
    ``kept`` whether that is the row's own. Vectors that are NULL, empty, all zero or have NULL or non-finite
    components link with nothing, as do vectors of unlike lengths. Further columns don't matter; no rows give none.
    """
    element = embeddings.schema["embedding"].dataType
    single = isinstance(element, ArrayType) and isinstance(element.elementType, FloatType)
    kind, cast = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    given = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(cast).alias("embedding"))
    rows = given.mapInArrow(_hashed(kind), "vec_id long, digest binary, size int, data binary")
    scratch = Scratch(embeddings.sparkSession, "vectors")
    valid = rows.where(F.col("digest").isNotNull()).groupBy("digest")
    classes = valid.agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.first("size").alias("size"), F.first("data").alias("data"))
    classes = scratch.saved(classes.withColumn("name", F.monotonically_increasing_id()), "classes")
    sizes = [row.size for row in classes.select("size").distinct().orderBy("size").collect()]
    parts = [_links(classes.where(F.col("size") == size), size, kind, cosine, block_rows, tile_rows, scratch) for size in sizes]
    if not parts:
        return given.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = scratch.saved(reduce(DataFrame.unionByName, parts), "links")
    numbers = links.groupBy("name").agg(F.sum("links").alias("links"))
    roots = connected(links.select(F.col("name").alias("a"), F.col("root").alias("b"))).withColumnRenamed("fp", "name")
    rooted = classes.select("digest", "name", "n", "least").join(roots, "name", "left").join(numbers, "name", "left")
    rooted = rooted.select("digest", F.coalesce("root", "name").alias("root"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "least")
    rooted = scratch.saved(rooted, "rooted")
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.saved(rooted.join(components, "root").select("digest", "n_links", "component_id"), "named")
    joined = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    found = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
