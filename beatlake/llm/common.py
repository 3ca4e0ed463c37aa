"""What several corpus operators share: tables of a run, text rules, folds and bounded samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from beatlake.session import shared_folder

# White space of ASCII; a word is what stands between, whatever script it is in.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
LOWER_ASCII = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
SAMPLE_BYTES = 1 << 18
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job that runs inside go when that job ends, not when the driver collects its garbage."""
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid4().hex}"


def saved(frame: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The frame written to the cluster's shared folder and read again: computed once, and safe when executors go."""
    spark = frame.sparkSession
    path = path or new_path(spark, name)
    with freed_shuffles(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def unique_ids(documents: DataFrame) -> bool:
    """Whether every row has an id and no two have the same."""
    rows, ids = documents.agg(F.count("*"), F.countDistinct("doc_id")).first()
    return rows == ids


def numbered_rows(documents: DataFrame, row: str, name: str) -> DataFrame:
    """The rows with a unique long: their ids where those are unique, else numbers in a written table."""
    if unique_ids(documents):
        return documents.withColumn(row, F.col("doc_id").cast("long"))
    return saved(documents.withColumn(row, F.monotonically_increasing_id()), name)


def removed(spark: SparkSession, path: str) -> None:
    """Removes a table of this run that nothing reads any more."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """Intermediate tables of one call by name, so that those that nothing reads any more can go before its end."""

    def __init__(self, spark: SparkSession, prefix: str) -> None:
        self.spark, self.prefix, self.paths = spark, prefix, {}

    def saved(self, frame: DataFrame, name: str) -> DataFrame:
        self.paths[name] = path = new_path(self.spark, f"{self.prefix}-{name}")
        return saved(frame, "", path)

    def drop(self, *names: str) -> None:
        for name in names:
            removed(self.spark, self.paths.pop(name))


def crc_fold(doc_id: str, folds: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def excerpt(text: Column, size: int, slices: int = 16) -> Column:
    """The bytes of a text, or where there are more than ``size``, evenly spread slices of about that size together."""
    length = F.octet_length(text)
    parts = [F.substring(text, F.floor(length * at / slices).cast("int") + 1, F.lit(size // slices - 1)) for at in range(slices)]
    spaced = [x for part in parts for x in (part, F.lit(b" "))]
    return F.when(length <= size, text).otherwise(F.concat(*spaced))


def lowest(frame: DataFrame, limit: int, *ties: str) -> list[Row]:
    """The ``limit`` rows with the least hash ``turn``, collected.

    A bound on the hash lets about twice as many through before the sort, so that tasks don't send ``limit``
    rows each to the driver; where too few pass it, all rows take part.
    """
    total = frame.count()
    if total > 2 * limit:
        below = frame.where(F.col("turn") < int((2 * limit / total - 0.5) * 2**64))
        rows = below.orderBy("turn", *ties).limit(limit).collect()
        if len(rows) == limit:
            return rows
    return frame.orderBy("turn", *ties).limit(limit).collect()


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, limit: int, learn: Column
) -> list[tuple[int, bytes, int]]:
    """At most ``limit`` labelled texts a class, those whose ids hash lowest; NULL texts are empty.

    ``learn`` says which ids may be learned from. Of several labels of one id the smallest counts. The ids
    are chosen before any text is read, so that the texts are found without a shuffle of the documents. Of texts
    longer than ``SAMPLE_BYTES`` an excerpt is learned from, which bounds the sample without losing a class.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .withColumn("turn", F.xxhash64("doc_id"))
    )
    kept = [
        (row.doc_id, row.label)
        for value in (0, 1)
        for row in lowest(chosen.where(F.col("label") == value), limit, "doc_id")
    ]
    if not kept:
        return []
    ids = documents.sparkSession.createDataFrame(kept, "doc_id long, label int")
    rows = (
        documents.select("doc_id", excerpt(F.coalesce(F.col("text"), F.lit("")).cast("binary"), SAMPLE_BYTES).alias("text"))
        .join(F.broadcast(ids), "doc_id")  # 2 x limit rows at most
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("label").alias("label"))
        .collect()
    )
    return sorted((row.doc_id, bytes(row.text), row.label) for row in rows)


def words_of(text: bytes) -> list[bytes]:
    """Words of UTF-8 text; bytes.split() splits at the six ASCII spaces and nothing else."""
    return text.split()


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that no column of the input has, however its case is written."""
    low = {name.lower() for name in taken}
    while wanted.lower() in low:
        wanted += "_"
    return wanted


class Codes(dict):
    """Numbers of words by a rule, remembered; forgotten when there are too many, so that memory stays bounded."""

    LIMIT = 500_000

    def __init__(self, rule: Callable[[bytes], int]) -> None:
        super().__init__()
        self.rule = rule

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = code = self.rule(word)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def pieces(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A very long text in pieces that end at a space, or where there is none within ``size`` bytes, anywhere."""
    begin = 0
    while len(text) - begin > size:
        end = max(text.rfind(b" ", begin, begin + size), text.rfind(b"\n", begin, begin + size)) + 1
        end = end or begin + size
        yield text[begin:end]
        begin = end
    yield text[begin:]


def scrambled(values: np.ndarray) -> np.ndarray:
    """64-bit numbers spread over all bits."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -30, 30)))

