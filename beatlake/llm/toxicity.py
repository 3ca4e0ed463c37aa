"""Toxicity by a convolutional text classifier over hashed word embeddings.

A word's embedding is the sum of the rows that the word and its first four and five bytes hash to, so that
unseen forms of a known stem are near it. Filters over one, two and three words are max-pooled over the whole
text and feed a logistic output. Training is plain numpy (Adagrad): the start on at most ``LIMIT`` labelled texts a
class, then ``PASSES`` passes over every labelled text, dealt over the tasks, whose models are averaged after each
pass. As only the words that win a pool get a gradient, a step costs little more than the scoring of its texts.

Scores know nothing of languages. Thresholds are calibrated by language afterwards, on all labelled texts that
training left aside, and make the column ``flagged``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from copy import deepcopy
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from beatlake.llm.common import LOWER_ASCII, Codes, Scratch, crc_fold, freed_shuffles, labelled_sample, pieces, sigmoid

BITS = 15
ROWS = 1 << BITS
DIM = 12
FILTERS = 8
WIDTHS = (1, 2, 3)
LIMIT = 2_000
EPOCHS = 5
MIN_STEPS = 500
BATCH = 48
RATE = 0.08
DECAY = 1e-4
PASSES = 2
SHARD_ROWS, SHARDS = 4096, 256  # texts a task trains on, and tasks of a pass at most
BINS = 256  # of a logit, for calibration
TASK_WORDS = 1 << 17
PREDICT = 0.5
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _code(word: bytes) -> int:
    """The three table rows of a word in one number."""
    return crc32(word) % ROWS | crc32(b"4" + word[:4]) % ROWS << 16 | crc32(b"5" + word[:5]) % ROWS << 32


def new_codes() -> Codes:
    return Codes(_code)


def rows_of(text: bytes, codes: Codes) -> np.ndarray:
    """(words, 3) table rows of a text."""
    parts = [codes.of(WORD.findall(piece)) for piece in pieces(text.translate(LOWER_ASCII))]
    packed = np.concatenate(parts) if len(parts) > 1 else parts[0]
    return np.stack([(packed >> np.uint64(shift) & np.uint64(0xFFFF)).astype(np.int32) for shift in (0, 16, 32)], axis=1)


@dataclass
class ToxicityModel:
    table: np.ndarray
    kernels: list[np.ndarray]  # (width, DIM, FILTERS) each
    offsets: list[np.ndarray]
    output: np.ndarray
    bias: np.ndarray
    prior: float = 0.0

    def pooled(self, words: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Max-pooled filters of one text's embeddings (with zeros after it), and the places that won."""
        values, places = [], []
        for kernel, offset in zip(self.kernels, self.offsets):
            many = max(1, len(words) - len(kernel) + 1)
            total = np.tile(offset, (many, 1))
            for step in range(len(kernel)):
                part = words[step : step + many]
                total[: len(part)] += part @ kernel[step]
            won = total.argmax(axis=0)
            places.append(won)
            values.append(total[won, np.arange(FILTERS)])
        return np.concatenate(values), places

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        return self.table[rows[:, 0]] + self.table[rows[:, 1]] + self.table[rows[:, 2]]

    def pooled_whole(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of a text of any length: pools of blocks of words that overlap by a filter's width, pooled again."""
        best = places = None
        for begin in range(0, max(1, len(rows)), TASK_WORDS):
            part, found = self.pooled(self.embedded(rows[begin : begin + TASK_WORDS + max(WIDTHS) - 1]))
            found = np.stack(found) + begin
            if best is None:
                best, places = part, found
            else:
                better = (part > best).reshape(found.shape)
                best, places = np.maximum(best, part), np.where(better, found, places)
        return best, places

    def logit(self, rows: np.ndarray) -> float:
        best, _ = self.pooled_whole(rows)
        return float(np.maximum(best, 0) @ self.output + self.bias[0] + self.prior)

    def parameters(self) -> list[np.ndarray]:
        return [self.table, *self.kernels, *self.offsets, self.output, self.bias]


def learn(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> ToxicityModel:
    """A model of labelled texts, the same for the same texts."""
    return _started(texts, labels, epochs)[0]


def _started(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> tuple[ToxicityModel, list[np.ndarray]]:
    """A model of labelled texts and the squares of its gradients so far."""
    random = np.random.default_rng(0)
    model = ToxicityModel(
        random.normal(0, 0.1, (ROWS, DIM)).astype(np.float32),
        [random.normal(0, 0.5 / width**0.5, (width, DIM, FILTERS)).astype(np.float32) for width in WIDTHS],
        [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS],
        random.normal(0, 0.5, len(WIDTHS) * FILTERS).astype(np.float32),
        np.zeros(1, dtype=np.float32),
    )
    codes = new_codes()
    rows = [rows_of(text, codes) for text in texts]
    truth = np.array(labels, dtype=np.float32)
    squares = [np.full_like(x, 1e-3) for x in model.parameters()]
    for _ in range(max(epochs, MIN_STEPS // max(1, -(-len(rows) // BATCH)) if epochs else 0)):
        order = random.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            chosen = order[begin : begin + BATCH]
            _step(model, squares, ((rows[at], truth[at]) for at in chosen), len(chosen))
    return model, squares


def _step(model: ToxicityModel, squares: list[np.ndarray], batch: Iterable[tuple[np.ndarray, float]], many: int) -> None:
    kernels = [np.zeros_like(kernel) for kernel in model.kernels]
    offsets = [np.zeros_like(offset) for offset in model.offsets]
    output, bias = DECAY * model.output, np.zeros_like(model.bias)
    touched: list[np.ndarray] = []
    gradients: list[np.ndarray] = []
    for rows, label in batch:
        values, places = model.pooled_whole(rows)
        active = np.maximum(values, 0)
        error = (float(sigmoid(active @ model.output + model.bias[0])) - label) / many
        output += error * active
        bias += error
        back = np.where(values > 0, error * model.output, 0).astype(np.float32)
        for at, (kernel, won) in enumerate(zip(model.kernels, places)):
            own = back[at * FILTERS : (at + 1) * FILTERS]
            offsets[at] += own
            for step in range(len(kernel)):
                place = won + step
                there = np.flatnonzero((place < len(rows)) & (own != 0))
                if not len(there):
                    continue
                kernels[at][step][:, there] += model.embedded(rows[place[there]]).T * own[there]
                touched.append(rows[place[there]])
                gradients.append(kernel[step][:, there].T * own[there, None])
    for value, square, gradient in zip(model.parameters()[1:], squares[1:], (*kernels, *offsets, output, bias)):
        square += gradient**2
        value -= RATE * gradient / np.sqrt(square)
    if touched:
        where = np.concatenate(touched)
        gradient = np.repeat(np.concatenate(gradients)[:, None], 3, axis=1).reshape(-1, DIM)
        unique, inverse = np.unique(where.ravel(), return_inverse=True)
        total = np.zeros((len(unique), DIM), dtype=np.float32)
        np.add.at(total, inverse, gradient)
        squares[0][unique] += total**2
        model.table[unique] -= RATE * total / np.sqrt(squares[0][unique])


def calibrated(logits: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float | None:
    """The logit from which on toxic gives the best F1, counting rows by their weights; None where a class is missing."""
    if not 0 < labels.sum() < len(labels):
        return None
    order = np.argsort(-logits, kind="stable")
    weights = np.ones(len(labels)) if weights is None else weights[order]
    hit = np.cumsum(labels[order] * weights)
    f1 = 2 * hit / (np.cumsum(weights) + hit[-1])
    best = int(f1.argmax())
    below = logits[order[best + 1]] if best + 1 < len(order) else logits[order[best]] - 2
    return float((logits[order[best]] + below) / 2)


def _scorer(model: ToxicityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = new_codes()
        for batch in batches:
            scores = [float(sigmoid(np.float64(model.logit(rows_of(text.as_py() or b"", codes))))) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores, pa.float64())], names=["doc_id", "lang", "score"]
            )

    return score


def _packed(model: ToxicityModel) -> np.ndarray:
    """All numbers of a model, in rows of ``DIM``."""
    flat = np.concatenate([array.ravel() for array in model.parameters()])
    return np.append(flat, np.zeros(-len(flat) % DIM, dtype=flat.dtype)).reshape(-1, DIM)


def _move(model: ToxicityModel, change: np.ndarray) -> None:
    begin = 0
    for array in model.parameters():
        array += change.ravel()[begin : begin + array.size].reshape(array.shape).astype(array.dtype)
        begin += array.size


def _pass(model: ToxicityModel, squares: list[np.ndarray]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Trains on every row (text, label) of a task, a batch in memory; what changed in the model comes out, times rows."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, own_squares = deepcopy(model), deepcopy(squares)
        codes, seen = new_codes(), 0
        held: list[tuple[bytes, int]] = []

        def step() -> None:
            _step(own, own_squares, ((rows_of(text, codes), label) for text, label in held), len(held))
            held.clear()

        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                held.append((text.as_py() or b"", label.as_py()))
                seen += 1
                if len(held) == BATCH:
                    step()
        if held:
            step()
        if seen:
            change = (_packed(own) - _packed(model)) * np.float32(seen)
            moved = np.flatnonzero(change.any(axis=1))
            lists = pa.ListArray.from_arrays(np.arange(0, len(moved) * DIM + 1, DIM, dtype=np.int32), change[moved].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(moved.astype(np.int32)), lists], names=["at", "change"])

    return train


def trained(model: ToxicityModel, squares: list[np.ndarray], rows: DataFrame, passes: int = PASSES) -> None:
    """Trains the model on all rows (doc_id, text, label), each pass in tasks of their own order.

    The average of the tasks' models, by the rows that each has seen, is the model that the next pass starts from, with
    the first model's ``squares``.
    """
    many = rows.count()
    shards = min(SHARDS, -(-many // SHARD_ROWS))
    if not shards:
        return
    for turn in range(passes):
        dealt = rows.withColumn("turn", F.xxhash64(F.lit(turn), "doc_id", "text"))
        dealt = dealt.repartition(shards, "turn").sortWithinPartitions("turn", "doc_id").select("text", "label")
        changes = dealt.mapInArrow(_pass(model, squares), "at int, change array<float>")
        sums = [F.sum(F.col("change")[at].cast("double")).alias(f"v{at}") for at in range(DIM)]
        with freed_shuffles(rows.sparkSession):
            found = changes.groupBy("at").agg(*sums).toArrow()  # one model, however many rows
        change = np.zeros(_packed(model).shape)
        for at in range(DIM):
            change[found.column("at").to_numpy(), at] = found.column(f"v{at}").to_numpy() / many
        _move(model, change)


def _logits(model: ToxicityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = new_codes()
        for batch in batches:
            found = np.array([model.logit(rows_of(text.as_py() or b"", codes)) for text in batch.column(0)])
            bins = np.round(np.clip(found, -30, 30) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1), batch.column(2)], names=["bin", "lang", "label"])

    return compute


def labelled_rows(documents: DataFrame, labels: DataFrame, learn_from: Column) -> DataFrame:
    """doc_id, text, lang, label and whether it is set aside, of every document whose label may be learned.

    Of several labels of one id the smallest counts; rows that share an id are each learned from.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learn_from)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("toxic").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1))
    )
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    texts = documents.where(learn_from).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), lang.alias("lang")
    )
    aside = F.crc32(F.concat(F.lit("calibrate"), F.col("doc_id").cast("string")).cast("binary")) % 5 == 0
    # One plan for all sizes: the ids grow with the input, so that a broadcast of them would end at some size.
    return texts.join(known.hint("shuffle_hash"), "doc_id").withColumn("aside", aside)


def fit(documents: DataFrame, labels: DataFrame, learn_from: Column, limit: int = LIMIT) -> tuple[ToxicityModel, dict[str, float]]:
    """The model and a threshold by language; a fifth of the labelled rows calibrates and is not trained on.

    Training starts on a sample that takes as many of either class as it can, and goes on over all rows. The score is
    shifted so that 0.5 is the best threshold for all rows set aside; thresholds by language come from the same rows,
    counted by their logits to 1 / ``BINS``.
    """
    scratch = Scratch(documents.sparkSession, "toxicity")
    rows = scratch.saved(labelled_rows(documents, labels, learn_from), "labelled")
    sample = [row for row in labelled_sample(rows, labels, "toxic", limit, learn_from) if crc32(b"calibrate%d" % row[0]) % 5]
    if len({label for *_, label in sample}) < 2:
        scratch.drop("labelled")
        empty = learn([], [], 0)
        empty.output[:] = 0
        return empty, {}
    model, squares = _started([text for _, text, _ in sample], [label for *_, label in sample])
    trained(model, squares, rows.where("NOT aside").select("doc_id", "text", "label"))
    logits = rows.where("aside").select("text", "lang", "label").mapInArrow(_logits(model), "bin long, lang string, label int")
    with freed_shuffles(documents.sparkSession):
        counts = logits.groupBy("lang", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).collect()
    scratch.drop("labelled")

    def limit_of(chosen: list[Row]) -> float | None:
        many, toxic = {}, {}
        for row in chosen:
            many[row.bin] = many.get(row.bin, 0) + row.n
            toxic[row.bin] = toxic.get(row.bin, 0) + row.toxic
        bins = np.array(sorted(many))
        weights = np.array([many[at] for at in sorted(many)], dtype=np.float64)
        return calibrated(bins / BINS, np.array([toxic[at] for at in sorted(many)]) / weights, weights)

    best = limit_of(counts)
    model.prior = 0.0 if best is None else -best
    thresholds = {}
    for lang in sorted({row.lang for row in counts} - {None}):
        best = limit_of([row for row in counts if row.lang == lang])
        thresholds[lang] = PREDICT if best is None else float(sigmoid(np.float64(best + model.prior)))
    return model, thresholds


def score_toxicity(documents: DataFrame, labels: DataFrame, learn_from: Column, limit: int = LIMIT) -> DataFrame:
    """A row a document: doc_id, lang, score (the probability of label ``toxic`` 1 for the whole text), flagged.

    ``learn_from`` picks the ids whose labels may be learned. NULL and empty texts share one score. A language
    without a threshold (NULL, or unseen in calibration) is flagged at 0.5. Repeated rows and ids are each
    scored, no rows give no rows. Of further columns only lang is read, and only for ``flagged``.
    """
    model, thresholds = fit(documents, labels, learn_from, limit)
    lang = F.col("lang").cast("string") if "lang" in documents.columns else F.lit(None).cast("string")
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), lang.alias("lang")
    )
    scored = source.mapInArrow(_scorer(model), "doc_id long, lang string, score double")
    limits = F.create_map(*[F.lit(x) for pair in thresholds.items() for x in pair]) if thresholds else None
    limit_of = F.lit(PREDICT) if limits is None else F.coalesce(limits[F.col("lang")], F.lit(PREDICT))
    return scored.withColumn("flagged", F.col("score") >= limit_of)


def judged(documents: DataFrame, labels: DataFrame, folds: int = 5, out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted, flagged; ids of fold ``out`` are not learned from. A NULL id is held out."""
    fold = F.coalesce(crc_fold("doc_id", folds), F.lit(out)) == out
    scored = score_toxicity(documents, labels, ~fold)
    return scored.select(
        "doc_id", fold.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"), "flagged"
    )
