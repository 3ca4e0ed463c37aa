"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes between two spaces in both directions, labels every position with a
distribution over the languages, and a document's probability of a language is the mean over the positions of
its words that have a letter. It is trained in numpy by backpropagation through time on words of a bounded
sample of texts. A word is a sequence of its own, so that a word's labels are computed once and remembered.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatlake.llm.common import crc_fold, excerpt, pieces

HIDDEN = 16
MAX_BYTES = 24  # longer words are read in parts
SAMPLE_TEXTS = 1_500
SAMPLE_WORDS = 60
SAMPLE_BYTES = 1 << 16
STEPS = 500
BATCH = 256
RATE = 0.02
REMEMBERED = 200_000
AT_ONCE = 1 << 13
TEXTS_AT_ONCE = 512
UNKNOWN = "und"
LETTER = re.compile(rb"[A-Za-z]")
LETTERS = re.compile(rb"[A-Za-z\x80-\xff]")
Gates = dict[str, np.ndarray]


def has_letter(text: bytes) -> bool:
    return bool(LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def parts_of(word: bytes) -> list[bytes]:
    return [word[at : at + MAX_BYTES] for at in range(0, len(word), MAX_BYTES)]


def _hard(values: np.ndarray) -> np.ndarray:
    """A sigmoid of three straight lines, which costs a fraction of the smooth one."""
    values = values * np.float32(0.25)
    values += np.float32(0.5)
    return _clipped(values, np.float32(0))


def _clipped(values: np.ndarray, least: np.float32) -> np.ndarray:
    np.maximum(values, least, out=values)
    return np.minimum(values, np.float32(1), out=values)


@dataclass
class Direction:
    """One direction's gates: z (update), r (reset), c (candidate), each from the byte and the state."""

    byte: np.ndarray  # (256, 3 HIDDEN), with the biases
    state: np.ndarray  # (HIDDEN, 2 HIDDEN) for z and r
    candidate: np.ndarray  # (HIDDEN, HIDDEN)

    def states(self, codes: np.ndarray, keep: list[tuple] | None = None) -> list[np.ndarray]:
        """States after each column of ``codes`` (words, steps); ``keep`` gets what backpropagation needs."""
        now = np.zeros((len(codes), HIDDEN), dtype=np.float32)
        out = []
        for step in range(codes.shape[1]):
            given = self.byte[codes[:, step]]
            gates = _hard(given[:, : 2 * HIDDEN] + now @ self.state)
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            gated = reset * now
            new = _clipped(given[:, 2 * HIDDEN :] + gated @ self.candidate, np.float32(-1))
            after = now + update * (new - now)
            if keep is not None:
                keep.append((now, update, reset, gated, new, codes[:, step]))
            now = after
            out.append(now)
        return out

    def back(self, keep: list[tuple], wanted: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gradients of the three matrices, from those of the states, through time."""
        byte, state, candidate = np.zeros_like(self.byte), np.zeros_like(self.state), np.zeros_like(self.candidate)
        flow = np.zeros_like(wanted[0])
        for (before, update, reset, gated, new, codes), own in zip(reversed(keep), reversed(wanted)):
            flow = flow + own
            into_new = flow * update * (np.abs(new) < 1)
            into_update = flow * (new - before)
            into_gated = into_new @ self.candidate.T
            gates = np.concatenate((into_update, into_gated * before), axis=1)
            both = np.concatenate((update, reset), axis=1)
            gates = gates * np.float32(0.25) * ((both > 0) & (both < 1))
            candidate += gated.T @ into_new
            state += before.T @ gates
            np.add.at(byte, codes, np.concatenate((gates, into_new), axis=1))
            flow = flow * (1 - update) + into_gated * reset + gates @ self.state.T
        return byte, state, candidate


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Direction
    backward: Direction
    output: np.ndarray  # (2 HIDDEN, languages)
    bias: np.ndarray

    def matrices(self) -> list[np.ndarray]:
        one, two = self.forward, self.backward
        return [one.byte, one.state, one.candidate, two.byte, two.state, two.candidate, self.output, self.bias]

    def labels(self, words: list[bytes]) -> np.ndarray:
        """(words, positions, languages) probabilities for words of one length; positions are the word's bytes."""
        codes = coded(words)
        ahead = self.forward.states(codes)
        behind = self.backward.states(codes[:, ::-1])[::-1]
        both = np.concatenate((np.stack(ahead[1:-1], axis=1), np.stack(behind[1:-1], axis=1)), axis=2)
        return softmax(both @ self.output + self.bias)


def coded(words: list[bytes]) -> np.ndarray:
    """Byte codes of words of one length, between two spaces."""
    codes = np.frombuffer(b"".join(b" " + word + b" " for word in words), dtype=np.uint8)
    return codes.reshape(len(words), -1).astype(np.int64)


def softmax(values: np.ndarray) -> np.ndarray:
    grown = np.exp(values - values.max(axis=-1, keepdims=True))
    return grown / grown.sum(axis=-1, keepdims=True)


def learn(sample: list[tuple[bytes, str]], steps: int = STEPS) -> LanguageModel | None:
    """A model of (text, language) rows, the same for the same rows; None without any."""
    languages = sorted({lang for _, lang in sample})
    random = np.random.default_rng(0)
    by_length: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
    for text, lang in sample:
        words = [word for word in text.split() if LETTERS.search(word)]
        if words:
            for at in random.integers(0, len(words), SAMPLE_WORDS):
                for part in parts_of(words[at]):
                    by_length[len(part)].append((part, languages.index(lang)))
    if not languages:
        return None

    def direction() -> Direction:
        return Direction(*(random.normal(0, 0.25, shape).astype(np.float32) for shape in ((256, 3 * HIDDEN), (HIDDEN, 2 * HIDDEN), (HIDDEN, HIDDEN))))

    model = LanguageModel(
        languages, direction(), direction(), random.normal(0, 0.25, (2 * HIDDEN, len(languages))).astype(np.float32),
        np.zeros(len(languages), dtype=np.float32),
    )
    if not by_length or len(languages) < 2:
        return model
    # Languages count alike, however many texts they have.
    seen = np.bincount([lang for own in by_length.values() for _, lang in own], minlength=len(languages))
    weights = (seen.sum() / np.maximum(seen, 1) / len(languages)).astype(np.float32)
    means = [np.zeros_like(x) for x in model.matrices()]
    squares = [np.zeros_like(x) for x in model.matrices()]
    lengths = sorted(by_length)
    chances = np.array([length * len(by_length[length]) for length in lengths], dtype=float)
    for step in range(1, steps + 1):
        own = by_length[lengths[random.choice(len(lengths), p=chances / chances.sum())]]
        batch = [own[at] for at in random.integers(0, len(own), BATCH)]
        gradients = _gradients(model, [word for word, _ in batch], np.array([lang for _, lang in batch]), weights)
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for value, mean, square, gradient in zip(model.matrices(), means, squares, gradients):
            mean += 0.1 * (gradient - mean)
            square += 0.01 * (gradient**2 - square)
            value -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
    return model


def _gradients(model: LanguageModel, words: list[bytes], truth: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy over all positions of the words."""
    codes = coded(words)
    kept: tuple[list, list] = ([], [])
    ahead = model.forward.states(codes, kept[0])
    behind = model.backward.states(codes[:, ::-1], kept[1])[::-1]
    both = np.concatenate((np.stack(ahead[1:-1], axis=1), np.stack(behind[1:-1], axis=1)), axis=2)
    error = softmax(both @ model.output + model.bias)
    error[np.arange(len(words)), :, truth] -= 1
    error *= (weights[truth] / np.float32(error.shape[0] * error.shape[1]))[:, None, None]
    output = both.reshape(-1, 2 * HIDDEN).T @ error.reshape(-1, error.shape[2])
    states = error @ model.output.T
    edge = np.zeros((len(words), HIDDEN), dtype=np.float32)
    onward = [edge, *np.moveaxis(states[:, :, :HIDDEN], 1, 0), edge]
    backward = [edge, *np.moveaxis(states[:, :, HIDDEN:], 1, 0), edge][::-1]
    return [*model.forward.back(kept[0], onward), *model.backward.back(kept[1], backward), output, error.sum(axis=(0, 1))]


class Reader:
    """A model with the sums of labels of the words it has read; a bounded number of words is remembered."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {b"": 0}
        self.sums = np.zeros((1 << 12, len(self.model.languages) + 1), dtype=np.float32)  # the last one: positions

    def read(self, words: set[bytes]) -> None:
        new: dict[int, list[bytes]] = defaultdict(list)
        for word in words:
            if word not in self.place:
                new[len(word)].append(word)
        for length, group in sorted(new.items()):
            for begin in range(0, len(group), AT_ONCE):
                some = group[begin : begin + AT_ONCE]
                at = len(self.place)
                while at + len(some) > len(self.sums):
                    self.sums = np.concatenate((self.sums, np.zeros_like(self.sums)))
                for word in some:
                    self.place[word] = len(self.place)
                lettered = np.array([bool(LETTERS.search(word)) for word in some])
                summed = self.model.labels(some).sum(axis=1)
                self.sums[at : at + len(some), :-1] = np.where(lettered[:, None], summed, 0)
                self.sums[at : at + len(some), -1] = np.where(lettered, length, 0)

    def probabilities(self, text: bytes) -> np.ndarray:
        """Mean label of all positions of the text's words that have a letter."""
        total = np.zeros(self.sums.shape[1])
        for piece in pieces(text):
            words = [part for word in piece.split() for part in (parts_of(word) if len(word) > MAX_BYTES else (word,))]
            if len(self.place) > 2 * REMEMBERED:  # only very long texts get here
                self.forget()
            self.read(set(words))
            where = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
            total += self.sums[where].sum(axis=0, dtype=np.float64)
        return total[:-1] / max(total[-1], 1)


def _predictor(model: LanguageModel | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model) if model else None
        for batch in batches:
            values = [text.as_py() for text in batch.column(1)]
            if reader:  # the new words of all texts together make long rows of equal lengths
                for begin in range(0, len(values), TEXTS_AT_ONCE):
                    if len(reader.place) > REMEMBERED:
                        reader.forget()
                    reader.read({w for text in values[begin : begin + TEXTS_AT_ONCE] if text and len(text) < 1 << 20 for w in text.split() if len(w) <= MAX_BYTES})
                    _fill(reader, values, begin, begin + TEXTS_AT_ONCE)
            rows = [(UNKNOWN, 0.0) if not reader or value is None else value for value in values]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([lang for lang, _ in rows], pa.string()), pa.array([score for _, score in rows], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return predict


def _fill(reader: Reader, values: list, begin: int, end: int) -> None:
    """Replaces texts by (language, probability)."""
    for at in range(begin, min(end, len(values))):
        text = values[at]
        if not text or not has_letter(text):
            values[at] = (UNKNOWN, 0.0)
            continue
        chances = reader.probabilities(text)
        best = int(chances.argmax())
        values[at] = (reader.model.languages[best], float(min(1.0, max(0.0, chances[best]))))


def sampled(documents: DataFrame, learn_from: Column, limit: int = SAMPLE_TEXTS) -> list[tuple[bytes, str]]:
    """Texts and languages of at most ``limit`` ids a language, those that hash lowest; of long texts an excerpt.

    One scan counts the languages, a second one takes the texts: a bound on the hash of an id lets about three times
    as many of each language through as are wanted.
    """
    known = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn_from)
    text = excerpt(F.col("text").cast("binary"), SAMPLE_BYTES).alias("text")
    known = known.select("doc_id", F.col("lang").cast("string").alias("lang"), F.xxhash64("doc_id").alias("turn"), text)
    bounds = [
        (row.lang, (1 << 63) - 1 if row.n <= 3 * limit else int((3 * limit / row.n - 0.5) * 2**64))
        for row in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    ]
    if not bounds:
        return []
    bound = F.broadcast(documents.sparkSession.createDataFrame(bounds, "lang string, bound long"))  # a row a language
    drawn = known.join(bound, "lang").where("turn <= bound").groupBy("lang", "turn", "doc_id").agg(F.min("text").alias("text"))
    turns = Window.partitionBy("lang").orderBy("turn", "doc_id")
    rows = drawn.withColumn("at", F.row_number().over(turns)).where(F.col("at") <= limit).orderBy("doc_id", "lang").collect()
    return [(bytes(row.text), row.lang) for row in rows]


def identify(documents: DataFrame, learn_from: Column, limit: int = SAMPLE_TEXTS) -> DataFrame:
    """A row a document: doc_id, lang_pred, score (the mean probability of that language over all positions).

    ``learn_from`` picks the ids whose lang may be learned. NULL texts and texts without a letter are ``und``
    with score 0, and so is everything where no language is known. Repeated rows and ids are each predicted, no
    rows give no rows. Only doc_id, text and, for learning, lang are read.
    """
    model = learn(sampled(documents, learn_from, limit))
    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(_predictor(model), "doc_id long, lang_pred string, score double")


def judged(documents: DataFrame, folds: int = 4, out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; ids of fold ``out`` are not learned from. A NULL id is held out."""
    fold = F.coalesce(crc_fold("doc_id", folds), F.lit(out)) == out
    return identify(documents, ~fold).select("doc_id", fold.alias("held_out"), "lang_pred", "score")
