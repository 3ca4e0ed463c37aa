"""Repeated byte strings of all documents by bucket-pointer refinement.

Initial buckets: every window of 100 bytes belongs to the bucket of its anchor, the gram of 32 bytes in it with
the least name. One anchor stands for some thirty windows in a row, so that a text of n bytes makes n / 30 rows.
A bucket with one member is finished: its windows are unique. Of the rest, runs with equal contexts form
classes, and all but the first run of a class repeat it as a whole. Only the firsts of the classes, where a
bucket has several, are compared byte by byte.

Refinement: in each task, buckets of eight-byte grams over the classes' contexts are refined by sorting on the
bucket pointers of later offsets; each pass doubles the depth and sorts on the pointers that the last one left,
and members that are alone in their bucket take no further part. Buckets with very many classes don't meet in
one task; their windows are named and aggregated instead, partially before the shuffle.

The order that says which string starts earlier is that of the ids, then of the offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import Scratch, free_name, saved, unique_ids

LENGTH = 100
GRAM = 32
FIRST_GRAM = 8
LARGE_BUCKET = 1024
TASK_BYTES = 4 << 20
COVER = 5  # a context has up to 2 * LENGTH - GRAM bytes, so that this many steps between grams leave no gap
BLOCK = 1 << 19
SHARES = 4  # of the anchors, by their names
POSITION = np.uint64((1 << 20) - 1)
ODD = np.uint64(0x9E3779B97F4A7C15)  # 2**64 / golden ratio
OTHER_ODD = np.uint64(0xD6E8FEB86659FD93)


def _spread(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * OTHER_ODD
    return values ^ (values >> np.uint64(29))


BYTE_NAMES = _spread((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)


def gram_names(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A 64-bit bucket name for the ``gram`` (a power of two) bytes at every offset.

    The bucket of twice the length is named by the buckets at an offset and one length later, over and over.
    """
    names, step = BYTE_NAMES[data], 1
    while step < gram:
        names = names[:-step] * ODD + names[step:]
        names ^= names >> np.uint64(31)
        step *= 2
    return _spread(names)


def runs(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchor name, context name, first window, anchor's offset in it, and number of windows, of every run.

    The anchor of a window of ``length`` bytes is its gram with the least name, of equal ones the last; windows
    in a row with the same anchor form a run. Equal windows have equal anchors at equal offsets. The context is
    all bytes of the run's windows with the anchor's place in them, named by the grams that cover them.
    """
    width = length - gram + 1
    for begin in range(0, max(0, len(data) - length + 1), BLOCK):
        names = gram_names(data[begin : begin + BLOCK + length - 1], gram)
        least = (names & ~POSITION) | (POSITION - np.arange(len(names), dtype=np.uint64))
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if width > step:
            least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
        first = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        anchor = (POSITION - (least[first] & POSITION)).astype(np.int64)
        many = np.diff(np.append(first, len(least)))
        context = ((anchor - first) << 8 | many).astype(np.uint64) * ODD
        for part in range(COVER + 1):
            context = _spread(context * ODD + names[first + (many + length - 1 - gram) * part // COVER])
        yield names[anchor], context, first + begin, anchor - first, many


def refined(data: np.ndarray, sizes: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket pointers at depth ``length`` of all windows of texts that lie one after another in ``data``.

    Equal windows have equal pointers. Windows come in order of their texts and offsets; every text has at
    least ``length`` bytes.
    """
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    left = np.repeat(starts + sizes, sizes) - np.arange(len(data))  # bytes from here to the end of the text
    packed = np.zeros(len(data), dtype=np.uint64)
    padded = np.concatenate((data, np.zeros(FIRST_GRAM, dtype=np.uint8))).astype(np.uint64)
    for offset in range(FIRST_GRAM):
        packed = packed << np.uint64(8) | padded[offset : offset + len(data)]
    pointer = np.full(len(data), -1, dtype=np.int64)
    alone = np.zeros(len(data), dtype=bool)

    def point(places: np.ndarray, keys: np.ndarray, base: np.ndarray | None) -> None:
        """Sorts places by key; a bucket's pointer is the rank of its first member among those of its old bucket."""
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1]))
        begin = np.flatnonzero(new)
        bucket = np.cumsum(new) - 1
        if base is None:
            rank = begin[bucket]
        else:
            old = pointer[places]
            old_new = np.concatenate(([True], old[1:] != old[:-1]))
            rank = old + begin[bucket] - np.flatnonzero(old_new)[np.cumsum(old_new) - 1]
        pointer[places] = rank
        alone[places] = (np.diff(np.append(begin, len(places))) == 1)[bucket]

    point(*(lambda places: (places, packed[places], None))(np.flatnonzero(left >= FIRST_GRAM)))
    depth = FIRST_GRAM
    while depth < length:
        step = min(depth, length - depth)
        places = np.flatnonzero((left >= depth + step) & ~alone)
        if not len(places):
            break
        # Two pointers make one key; both are below the number of bytes of a task.
        keys = pointer[places] << np.int64(31) | pointer[places + step]
        point(places, keys, pointer)
        depth += step
    return pointer[left >= length]


def repeated_windows(
    texts: list[bytes], order: np.ndarray, begin: np.ndarray, length: int = LENGTH
) -> Iterator[tuple[int, int, int]]:
    """(text, first, end): stretches of windows of the texts that start earlier, by (order, begin), elsewhere."""
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    turn = np.lexsort((begin, order))
    data = np.frombuffer(b"".join([texts[at] for at in turn]), dtype=np.uint8)
    pointer = refined(data, sizes[turn], length)
    many = sizes[turn] - length + 1
    _, firsts = np.unique(pointer, return_index=True)  # texts lie in their order, so the first index starts first
    repeated = np.ones(len(pointer), dtype=np.int8)
    repeated[firsts] = 0
    owner = np.repeat(np.arange(len(many)), many)
    offset = np.arange(len(pointer)) - np.repeat(np.cumsum(many) - many, many)
    joined = (repeated[1:] == 1) & (repeated[:-1] == 1) & (owner[1:] == owner[:-1])
    opens = np.flatnonzero((repeated == 1) & ~np.concatenate(([False], joined)))
    closes = np.flatnonzero((repeated == 1) & ~np.concatenate((joined, [False])))
    for a, b in zip(opens.tolist(), closes.tolist()):
        yield int(turn[owner[a]]), int(offset[a]), int(offset[b]) + 1


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for row, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            for anchor, context, first, offset, many in runs(np.frombuffer(value.as_py(), dtype=np.uint8)):
                place = first << 16 | offset << 8 | many
                for part, values in zip(parts, (np.full(len(place), row), anchor.view(np.int64), context.view(np.int64), place)):
                    part.append(values)
        if parts[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(part)) for part in parts], names=["row", "anchor", "context", "place"]
            )


def _contexts(large_bucket: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the runs asked for, or the names and offsets of their windows where the bucket is large."""
    fields = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, asked in zip(batch.column(1), batch.column(2)):
                rows: list[tuple] = []
                text = value.as_py()
                for run in asked.as_py():
                    first, many = run["place"] >> 16, run["place"] & 255
                    data = text[first : first + many + LENGTH - 1]
                    if run["n"] <= large_bucket:
                        rows.append((run["anchor"], None, run["row"], run["place"], data))
                        continue
                    one, two = (names.view(np.int64).tolist() for names in window_names(data, many))
                    rows += zip(one, two, [run["row"]] * many, range(first, first + many), [None] * many)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), fields)], names=["a", "b", "row", "place", "data"]
                )

    return read


def window_names(data: bytes, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each of the ``many`` windows of the data, from the grams that cover them."""
    names = gram_names(np.frombuffer(data, dtype=np.uint8))
    one = two = np.zeros(many, dtype=np.uint64)
    for offset in (0, GRAM, 2 * GRAM, LENGTH - GRAM):
        one = _spread(one * ODD + names[offset : offset + many])
        two = _spread((two ^ names[offset : offset + many]) * OTHER_ODD)
    return one, two


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that repeat, of contexts in order of their buckets; whole buckets are compared, many at a time."""
    held: list[tuple[int, int, int, bytes]] = []

    def flush(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        order = np.array([row for _, row, _, _ in rows])
        begin = np.array([place >> 16 for _, _, place, _ in rows])
        spans = [
            (rows[at][1], int(begin[at]) + first, int(begin[at]) + end - 1 + LENGTH)
            for at, first, end in repeated_windows([data for *_, data in rows], order, begin)
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int64()) for column in (zip(*spans) if spans else ([], [], []))], names=["row", "begin", "stop"]
        )

    size = 0
    for batch in batches:
        for item in zip(*(batch.column(at).to_pylist() for at in range(4))):
            if held and item[0] != held[-1][0] and size > TASK_BYTES:
                yield flush(held)
                held, size = [], 0
            held.append(item)
            size += len(item[3])
    if held:
        yield flush(held)


def ordered(documents: DataFrame) -> DataFrame:
    """row (a unique long in the order of the ids), doc_id and data; NULL ids come first, equal ids by text.

    Unique ids are their own rows. Only where ids repeat or lack is the table sorted and numbered.
    """
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data")
    )
    if unique_ids(documents):
        return source.select(F.col("doc_id").alias("row"), "doc_id", "data")
    return saved(
        source.orderBy("doc_id", "data").select(F.monotonically_increasing_id().alias("row"), "doc_id", "data"), "substrings-rows"
    )


def repeated_spans(source: DataFrame, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """row, begin, stop: spans of ``ordered`` texts covered by strings that also start earlier; they may overlap."""
    tables = Scratch(source.sparkSession, "substrings")
    anchors = tables.saved(
        source.select("row", "data").mapInArrow(_anchors, "row long, anchor long, context long, place long"), "anchors"
    )
    shared = []
    for share in range(SHARES):  # one after another, so that a share's shuffle is gone when the next one begins
        own = anchors.where(F.pmod(F.xxhash64("anchor"), F.lit(SHARES)) == share)
        several = tables.saved(own.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), f"several-{share}")
        shared.append(tables.saved(own.join(several, "anchor"), f"hits-{share}"))
        tables.drop(f"several-{share}")
    tables.drop("anchors")
    hits = reduce(DataFrame.unionByName, shared)
    here = F.struct("row", "place")
    classes = tables.saved(hits.groupBy("anchor", "context").agg(F.min(here).alias("first"), F.count("*").alias("n")), "classes")
    copies = hits.join(classes.where("n > 1").select("anchor", "context", "first"), ["anchor", "context"]).where(here != F.col("first"))
    begin = F.expr("place div 65536")
    spans = tables.saved(
        copies.select("row", begin.alias("begin"), (begin + F.col("place") % 256 + (LENGTH - 1)).alias("stop")), "copies"
    )
    tables.drop(*(f"hits-{share}" for share in range(SHARES)))
    many = tables.saved(classes.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"), "many")
    asked = tables.saved(classes.drop("n").join(many, "anchor").select("anchor", "n", "first.row", "first.place"), "asked")
    tables.drop("classes", "many")
    by_row = asked.groupBy("row").agg(F.collect_list(F.struct("row", "anchor", "n", "place")).alias("asked"))  # bounded by the text
    contexts = tables.saved(
        source.select("row", "data").join(by_row, "row").mapInArrow(_contexts(large_bucket), "a long, b long, row long, place long, data binary"),
        "contexts",
    )
    tables.drop("asked")
    compared = (
        contexts.where("b IS NULL").select("a", "row", "place", "data").repartition("a").sortWithinPartitions("a")
        .mapInArrow(_compared, "row long, begin long, stop long")
    )
    windows = contexts.where("b IS NOT NULL").select("a", "b", "row", "place")
    firsts = tables.saved(
        windows.groupBy("a", "b").agg(F.min(here).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "windows"
    )
    single = windows.join(firsts, ["a", "b"]).where(here != F.col("first"))
    found = tables.saved(
        spans.unionByName(compared).unionByName(
            single.select("row", F.col("place").alias("begin"), (F.col("place") + LENGTH).alias("stop"))
        ),
        "spans",
    )
    tables.drop("copies", "contexts", "windows")
    return found


def merged(spans: list[dict[str, int]] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the spans cover."""
    out: list[tuple[int, int]] = []
    for begin, stop in sorted((span["begin"], span["stop"]) for span in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((begin, stop))
    return out


def kept_parts(data: bytes, cut: list[tuple[int, int]]) -> list[bytes]:
    edges = [0, *(edge for span in cut for edge in span), len(data)]
    return [data[a:b] for a, b in zip(edges[::2], edges[1::2]) if a < b]


def with_spans(source: DataFrame, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    spans = repeated_spans(source, large_bucket).groupBy("row").agg(F.collect_list(F.struct("begin", "stop")).alias("spans"))
    return source.join(spans, "row", "left")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for value, spans in zip(batch.column(1), batch.column(2)):
            data, cut = value.as_py(), merged(spans.as_py())
            digest = sha256()
            for part in kept_parts(data, cut):
                digest.update(part)
            rows.append((len(data), sum(b - a for a, b in cut), len(cut), digest.hexdigest()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(column, pa.int64()) for column in columns[:3]), pa.array(columns[3], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def without_repeats(documents: DataFrame, large_bucket: int = LARGE_BUCKET) -> DataFrame:
    """A row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    NULL and empty texts have no bytes and lose none. Repeated rows and ids are documents of their own, in the
    order of their texts, so that all but the first copy of a text of 100 bytes or more lose every byte; NULL
    ids come first. No rows give no rows; further columns don't matter.
    """
    return with_spans(ordered(documents), large_bucket).select("doc_id", "data", "spans").mapInArrow(
        _digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last columns are a text's bytes and its spans, without the bytes of the spans and the column of spans."""
    for batch in batches:
        *others, data, spans = batch.columns
        texts = [
            None if not value.is_valid else value.as_py() if not cut.is_valid
            else b"".join(part.decode("utf-8", "ignore").encode() for part in kept_parts(value.as_py(), merged(cut.as_py())))
            for value, cut in zip(data, spans)
        ]
        yield pa.RecordBatch.from_arrays([*others, pa.array(texts, data.type)], names=batch.schema.names[:-1])


def cut_repeats(documents: DataFrame) -> DataFrame:
    """The documents without repeated strings, with all their columns; n_chars, if there, counts what is left.

    Characters that a cut leaves in part go too. Texts that lose everything stay, empty; a NULL text stays NULL.
    All columns meet the spans in one join, so that texts are shuffled once.
    """
    names = documents.columns
    row, cut = free_name("substrings_row", names), free_name("substrings_spans", names)
    if unique_ids(documents):
        numbered = documents.withColumn(row, F.col("doc_id").cast("long"))
    else:  # numbered in the order of the ids, as one table that all steps read
        numbered = saved(documents.orderBy("doc_id", "text").withColumn(row, F.monotonically_increasing_id()), "substrings-documents")
    source = numbered.select(F.col(row).alias("row"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    spans = repeated_spans(source).groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("begin", "stop")).alias(cut))
    plain = {name: f"column_{at}" for at, name in enumerate(names) if name != "text"}  # a map over Arrow takes no dots
    others = [F.col(f"`{name}`").alias(other) for name, other in plain.items()]
    given = numbered.join(spans, row, "left").select(*others, F.col("text").cast("binary").alias("text"), F.col(cut).alias("spans"))
    left = given.mapInArrow(_rewritten, given.drop("spans").schema)
    changed = {"text": F.col("text").cast("string")}
    if "n_chars" in names:
        changed["n_chars"] = F.length(changed["text"]).cast(numbered.schema["n_chars"].dataType)
    return left.select(*[(changed[name] if name in changed else F.col(plain[name])).alias(name) for name in names])
