"""Text quality by logistic regression on hashed word n-grams, learned by follow-the-regularised-leader.

Tokens are runs of letters and digits or runs of marks, lower-cased; a token equal to the one before it is the
token "again". Features are one- and two-token grams, hashed; a feature's value is its share of the text's
grams times ``SCALE``, so that a score doesn't depend on length. The learner sees at most ``LIMIT`` labelled
texts a class, one after another, and keeps a gradient sum and a squared sum a feature (FTRL-proximal).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatlake.llm.common import LOWER_ASCII, Codes, crc_fold, labelled_sample, pieces, scrambled, sigmoid

BITS = 18
SCALE = 20.0
LIMIT = 3_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
PREDICT = 0.7
TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\x20\x09-\x0D]+")
AGAIN = 1
NOTHING = 2


def token_codes(text: bytes, codes: Codes) -> Iterator[np.ndarray]:
    """Hashes of a text's grams, piece by piece; an empty text has the one gram "nothing"."""
    last, some = np.uint64(0), False
    for piece in pieces(text.translate(LOWER_ASCII)):
        tokens = codes.of(TOKEN.findall(piece))
        if not len(tokens):
            continue
        some = True
        before = np.concatenate(([last], tokens[:-1]))
        last = tokens[-1]
        tokens = np.where(tokens == before, np.uint64(AGAIN), tokens)
        pairs = tokens[:-1] * np.uint64(0x9E3779B97F4A7C15) + tokens[1:]
        yield scrambled(np.concatenate((tokens, pairs)))
    if not some:
        yield scrambled(np.array([NOTHING], dtype=np.uint64))


def new_codes() -> Codes:
    return Codes(lambda word: crc32(word) + 16)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    def score(self, text: bytes, codes: Codes) -> float:
        total, many = 0.0, 0
        for grams in token_codes(text, codes):
            total += float(self.weights[(grams >> np.uint64(64 - BITS)).astype(np.int64)].sum(dtype=np.float64))
            many += len(grams)
        return float(sigmoid(np.float64(self.bias + SCALE * total / many)))


def learn(sample: list[tuple[int, bytes, int]], epochs: int = EPOCHS) -> QualityModel:
    """A model of (id, text, label) rows, the same for the same rows; without rows of both classes it scores 0.5."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last one is the bias
    codes = new_codes()
    rows = []
    for _, text, label in sample:
        grams = np.concatenate(list(token_codes(text, codes))) >> np.uint64(64 - BITS)
        where, counts = np.unique(grams.astype(np.int64), return_counts=True)
        rows.append((np.append(where, size), np.append(SCALE * counts / len(grams), 1.0), label))
    if len({label for *_, label in rows}) < 2:
        return QualityModel(np.zeros(size, dtype=np.float32), 0.0)

    def weights(where: np.ndarray) -> np.ndarray:
        pull = np.where(where == size, 0.0, L1)
        free = np.sign(z[where]) * np.maximum(np.abs(z[where]) - pull, 0)
        return -free / ((BETA + np.sqrt(n[where])) / ALPHA + L2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            where, values, label = rows[at]
            now = weights(where)
            gradient = (sigmoid(now @ values) - label) * values
            squares = gradient**2
            z[where] += gradient - (np.sqrt(n[where] + squares) - np.sqrt(n[where])) / ALPHA * now
            n[where] += squares
    final = weights(np.arange(size + 1))
    return QualityModel(final[:size].astype(np.float32), float(final[size]))


def _scorer(model: QualityModel) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = new_codes()
        for batch in batches:
            scores = [model.score(text.as_py() or b"", codes) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return score


def score_quality(documents: DataFrame, labels: DataFrame, learn_from: Column, limit: int = LIMIT) -> DataFrame:
    """A row a document: doc_id and score, the probability of label ``quality`` 1 for the whole text.

    ``learn_from`` picks the ids whose labels may be learned. NULL and empty texts share one score. Repeated
    rows and ids are each scored; rows without labels too; no rows give no rows. Only doc_id and text are read.
    """
    model = learn(labelled_sample(documents, labels, "quality", limit, learn_from))
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(_scorer(model), "doc_id long, score double")


def judged(documents: DataFrame, labels: DataFrame, folds: int = 4, out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted; ids of fold ``out`` are not learned from. A NULL id is held out."""
    fold = F.coalesce(crc_fold("doc_id", folds), F.lit(out)) == out
    scored = score_quality(documents, labels, ~fold)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"))
