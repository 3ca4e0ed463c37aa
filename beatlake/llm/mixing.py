"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Slot n of the schedule gets the point n / golden ratio modulo 1 (kept as a whole number of 31 bits), which
falls into one source's part of the cumulative weights. The slots of a source are ranked, and its r-th slot
takes the r-th block of the source's shuffled stream of words, again from the front in the next epoch.

Slots are ranked and streams laid out in two steps, sums by chunk first, so that no source's rows have to
meet in one task. Only the table of sources is small by assumption (one row a source).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatlake.llm.common import WORD_CLASS, saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
EPOCHS = 2
BLOCK_WORDS = 1024
RING = 1 << 31
GOLDEN = 1327217885  # RING / golden ratio, odd
SHUFFLE = 1103515245  # odd, so that ids modulo RING are permuted
CELLS = 4096
CHUNK_SLOTS = 1 << 16
CHUNK_DOCS = 2_000


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source and number of words of every document."""
    counted = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD_CLASS))
    return documents.select("doc_id", "source", counted.cast("long").alias("size"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """A row a source: ix, source, source_size, rows, target.

    Targets are level x weight, or epochs x source_size where that is less; the level is the one at which they
    add up to ``share`` of all sizes. Sorted by the level at which each stops, what the earlier ones leave to
    the rest gives it without iteration.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    cycle = F.array(*map(F.lit, weights))
    numbered = by_source.withColumn(
        "ix", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long") - 1
    ).withColumn("weight", F.get(cycle, (F.col("ix") % len(weights)).cast("int")))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "ix")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        numbered.withColumn("cap", F.col("source_size") * epochs)
        .withColumn("words", F.sum("source_size").over(Window.partitionBy()) * F.lit(share))
        .withColumn("weights", F.sum("weight").over(Window.partitionBy()))
        .withColumn("turn", F.row_number().over(order))
        .withColumn(
            "level",
            (F.col("words") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0))),
        )
        .withColumn("open", F.col("level") < F.col("cap") / F.col("weight"))
        .withColumn("level", F.min_by("level", F.when(F.col("open"), F.col("turn"))).over(Window.partitionBy()))
    )
    first_open = F.min(F.when(F.col("open"), F.col("turn"))).over(Window.partitionBy())
    stops = first_open.isNull() | (F.col("turn") < first_open)
    return levels.withColumn(
        "target", F.when(stops, F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    ).select("ix", "source", "source_size", "rows", "target")


def _slots_needed(block: int) -> Column:
    whole, size = F.col("words"), F.col("source_size")
    return F.when(size == 0, F.lit(0)).otherwise(
        F.expr("words div source_size") * F.ceil(size / block) + F.ceil((whole % F.greatest(size, F.lit(1))) / block)
    ).cast("long")


def schedule(sources: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """ix, block, whole (how often the mix takes the block), upto (where a last take of it ends, else NULL), slot.

    The schedule has as many slots as all targets need. Ranks past a source's target stay empty, and what a
    source still lacks at the end (its discrepancy, a few slots) follows as its last slots. ``slot`` is the number of
    the first slot that takes the block.
    """
    spark = sources.sparkSession
    needed = saved(
        sources.withColumn("words", F.floor("target").cast("long"))
        .withColumn("slots", _slots_needed(block))
        .withColumn("below", F.coalesce(F.sum("slots").over(Window.orderBy("ix").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("total", F.sum("slots").over(Window.partitionBy()))
        .select("ix", "source_size", "words", "slots", "below", "total"),
        "mix-slots",
    )
    total = needed.agg(F.coalesce(F.max("total"), F.lit(0))).first()[0]
    width = RING // CELLS
    cells = (
        needed.where("slots > 0")
        .withColumn("low", F.floor(F.col("below") / F.col("total") * RING))
        .withColumn("high", F.floor((F.col("below") + F.col("slots")) / F.col("total") * RING))
        .where("high > low")
        .withColumn("cell", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))))
        .select("ix", "low", "high", "cell")
    )
    points = (
        spark.range(total)
        .withColumn("point", ((F.col("id") + 1) % RING) * GOLDEN % RING)
        .withColumn("cell", F.expr(f"point div {width}"))
        .withColumn("chunk", F.expr(f"id div {CHUNK_SLOTS}"))
    )
    drawn = points.join(cells, "cell").where("low <= point and point < high").select("id", "chunk", "ix")
    by_chunk = drawn.groupBy("ix", "chunk").agg(F.count("*").alias("n"))
    chunks = by_chunk.select(
        "ix", "chunk",
        (F.sum("n").over(Window.partitionBy("ix").orderBy("chunk")) - F.col("n")).alias("skip"),
    )
    ranked = (
        drawn.withColumn("place", F.row_number().over(Window.partitionBy("ix", "chunk").orderBy("id")) - 1)
        .join(chunks, ["ix", "chunk"])
        .select("ix", (F.col("skip") + F.col("place")).alias("rank"), F.col("id").alias("slot"))
    )
    lacking = (
        needed.join(by_chunk.groupBy("ix").agg(F.sum("n").alias("drawn")), "ix", "left")
        .withColumn("drawn", F.coalesce("drawn", F.lit(0)))
        .where("drawn < slots")
        .select("ix", F.explode(F.sequence("drawn", F.col("slots") - 1)).alias("rank"))
        .withColumn("slot", F.col("rank") + total)
    )
    return (
        ranked.unionByName(lacking)
        .join(needed.select("ix", "source_size", "words", "slots"), "ix")
        .where("rank < slots")
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("epoch", F.expr("rank div blocks"))
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .withColumn("left", F.col("words") - F.col("epoch") * F.col("source_size"))
        .withColumn("end", F.least((F.col("block") + 1) * block, F.col("source_size")))
        .groupBy("ix", "block")
        .agg(
            F.count(F.when(F.col("left") >= F.col("end"), 1)).alias("whole"),
            F.max(F.when(F.col("left") < F.col("end"), F.col("left"))).alias("upto"),
            F.min("slot").alias("slot"),
        )
    )


def streams(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """doc_id, size, ix and start: where each document begins in its source's shuffled stream of words.

    Rows of equal id and size are laid out as one and told apart afterwards, so that many of them fill no chunk.
    """
    most = sources.agg(F.coalesce(F.max("rows"), F.lit(0))).first()[0]
    chunks = max(1, -(-most // max(CHUNK_DOCS, isqrt(most))))  # chunks and rows of one grow alike
    keyed = (
        sized.join(sources.select("ix", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("turn", F.pmod(F.coalesce("doc_id", F.lit(-1)), F.lit(RING)) * SHUFFLE % RING)
        .withColumn("chunk", F.expr(f"turn * {chunks} div {RING}"))
        .groupBy("ix", "chunk", "turn", "doc_id", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("words", F.col("size") * F.col("copies"))
    )
    offsets = (
        keyed.groupBy("ix", "chunk").agg(F.sum("words").alias("n"))
        .select("ix", "chunk", (F.sum("n").over(Window.partitionBy("ix").orderBy("chunk")) - F.col("n")).alias("skip"))
    )
    order = Window.partitionBy("ix", "chunk").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        keyed.withColumn("upto", F.sum("words").over(order))
        .join(offsets, ["ix", "chunk"])
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        .select("doc_id", "size", "ix", (F.col("skip") + F.col("upto") - F.col("words") + F.col("copy") * F.col("size")).alias("start"))
    )


def mix(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    block: int = BLOCK_WORDS,
) -> DataFrame:
    """A row a document: doc_id, source, size, source_size, target, taken, first_slot.

    Sources by code point, NULL last, weigh ``weights`` in turn. Each source's taken words add up to its target
    rounded down. Sorted by ``first_slot``, the slot that first takes words of a document (NULL if none does), any
    stretch of the mix holds the sources in nearly the wanted shares. A NULL or empty text has size 0 and takes nothing; a NULL source is a source; repeated rows
    and repeated or NULL ids each stand for themselves; no rows give no rows. Other columns don't matter.
    """
    sized = saved(sizes(documents), "mix-sizes")
    sources = saved(targets(sized, weights, share, epochs), "mix-targets")
    laid = saved(streams(sized, sources), "mix-streams")
    pieces = (
        laid.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
        .withColumn("from", F.greatest("start", F.col("block") * block))
        .withColumn("to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block))
    )
    once = F.greatest(F.least("to", "upto") - F.col("from"), F.lit(0))
    taken = (
        pieces.join(schedule(sources, block), ["ix", "block"], "left")
        .withColumn("words", F.coalesce("whole", F.lit(0)) * (F.col("to") - F.col("from")) + F.when(F.col("upto").isNull(), 0).otherwise(once))
        .groupBy("ix", "start", "doc_id", "size")
        .agg(F.sum("words").alias("taken"), F.min(F.when(F.col("words") > 0, F.col("slot"))).alias("first_slot"))
    )
    none = [F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_slot")]
    nothing = laid.where("size = 0").select("ix", "start", "doc_id", "size", *none)
    return (
        taken.unionByName(nothing)
        .join(sources, "ix")
        .select("doc_id", "source", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "first_slot")
    )


# The targets by levels as above, what each document gives if every source's stream is read from its front until the
# target is reached, and the slots in the order of their numbers.
MIX_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD_CLASS}')) AS size FROM documents
), by_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS ix FROM by_source
), capped AS (
  SELECT *, [3, 1, 2][(ix % 3 + 1)::INT] AS weight, source_size * 2 AS cap FROM numbered
), ordered AS (
  SELECT *, row_number() OVER stops AS turn, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS words,
    (sum(weight) OVER ())::BIGINT AS weights, (coalesce(sum(cap) OVER before, 0))::BIGINT AS cap_before,
    (coalesce(sum(weight) OVER before, 0))::BIGINT AS weight_before
  FROM capped WINDOW stops AS (ORDER BY cap::DOUBLE / weight, ix),
    before AS (ORDER BY cap::DOUBLE / weight, ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, (words - cap_before) / (weights - weight_before) AS level FROM ordered
), opened AS (SELECT min(turn) AS turn FROM levels WHERE level < cap::DOUBLE / weight
), target AS (
  SELECT l.ix, l.source, l.source_size, CASE WHEN o.turn IS NULL OR l.turn < o.turn THEN l.cap::DOUBLE
    ELSE (SELECT level FROM levels JOIN opened USING (turn)) * l.weight END AS target
  FROM levels l, opened o
), laid AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY
      ((coalesce(doc_id, -1) % {RING} + {RING}) % {RING}) * {SHUFFLE} % {RING}, doc_id, size
      ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start FROM sized
), needed AS (
  SELECT ix, CASE WHEN source_size = 0 THEN 0 ELSE (floor(target)::BIGINT // source_size) * ((source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS})
    + (floor(target)::BIGINT % source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} END AS slots FROM target
), parts AS (
  SELECT ix, slots, coalesce(sum(slots) OVER (ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS below,
    (sum(slots) OVER ())::BIGINT AS total FROM needed
), points AS (
  SELECT id, ((id + 1) % {RING}) * {GOLDEN} % {RING} AS point FROM (SELECT unnest(range((SELECT max(total) FROM parts))) AS id)
), drawn AS (
  SELECT ix, slots, id AS slot, row_number() OVER (PARTITION BY ix ORDER BY id) - 1 AS rank FROM points JOIN parts
    ON floor(below::DOUBLE / total * {RING}) <= point AND point < floor((below + slots)::DOUBLE / total * {RING})
), ranked AS (
  SELECT ix, rank, slot FROM drawn WHERE rank < slots
  UNION ALL
  SELECT ix, rank, total + rank FROM (
    SELECT ix, total, unnest(range((SELECT count(*) FROM drawn d WHERE d.ix = p.ix), slots::BIGINT)) AS rank FROM parts p)
), given AS (
  SELECT doc_id, laid.source, size, source_size, target, ix, start,
    CASE WHEN source_size = 0 THEN 0 ELSE size * (floor(target)::BIGINT // source_size)
      + greatest(0, least(size, floor(target)::BIGINT % source_size - start)) END::BIGINT AS taken
  FROM laid JOIN target ON laid.source IS NOT DISTINCT FROM target.source
)
SELECT doc_id, source, size, source_size, target, taken, CASE WHEN taken > 0 THEN slot END AS first_slot
FROM given LEFT JOIN ranked ON ranked.ix = given.ix AND ranked.rank = given.start // {BLOCK_WORDS}
"""
