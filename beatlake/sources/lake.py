"""The raw event lake: ``root/<source id>/segment_type=<feed>/year=/month=/day=`` parquet."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatlake.sources.dates import day_folder, days_glob

# The source id is the directory that holds a platform's events.
SOURCE_IDS = {
    "web": "QoIWHsoWbK",
    "ios": "tVPKrSnQ8s",
    "android": "WCwpjnzJCv",
    "lr_roku": "vYnWYfQXdPu82NYN4xB3or",
    "lr_fire": "3S7cr7ZP4LPQwanZptak4X",
    "lr_xbox": "82QUauRB2fcLwFdhxrBkPc",
    "lr_apple": "kCuGxxttj19mqUtbiKLHyx",
    "lr_android": "kVJbcWwpbnqj9z2iT22ew6",
    "chat_js": "itvYWmS95YQ7hGnm2TErbe",
    "backend": "NtmpnPjgdx",
    "web_staging": "qvwPuJmpU6",
}
FALLBACK_PLATFORM = "android"

SCHEMA_READS = 16

# Internal columns of raw frames: where a row was loaded from, which its own columns need not say.
PLATFORM = "_platform"
RUN_DATE = "_run_date"
# The run date's name in day tables, where it is a partition.
INPUT_DAY = "input_day"

# Types of raw columns where they are not text. A file may have another one; see ``EventLake.slices``.
RAW_KINDS = {
    **dict.fromkeys(("received_at", "timestamp", "sent_at", "original_timestamp"), "timestamp"),
    **dict.fromkeys(("on_mobile_device", "has_sso", "has_video"), "boolean"),
    "position": "bigint",
}


def raw_schema(names: Iterable[str]) -> StructType:
    """The declared schema of raw columns."""
    schema = StructType()
    for name in dict.fromkeys(names):
        schema = schema.add(name, RAW_KINDS.get(name, "string"))
    return schema


def as_declared(found: StructType, declared: StructType, optional: Iterable[str]) -> bool:
    """Whether files of schema ``found`` can be read as declared and lack no column but optional ones."""
    kinds = {column.name: column.dataType.simpleString().removesuffix("_ntz") for column in found}
    lacking = {column.name for column in declared} - kinds.keys()
    return lacking <= set(optional) and all(
        kinds.get(column.name, kind) == kind for column in declared for kind in [column.dataType.simpleString()]
    )


def with_run_date(wanted: bool) -> list[Column]:
    """The input day as an output column, where a day table is to be written."""
    return [F.col(RUN_DATE).alias(INPUT_DAY)] if wanted else []


@dataclass(frozen=True)
class Slice:
    """Raw rows that share one schema, with the platforms they may come from."""

    rows: DataFrame
    platforms: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.rows.columns


def read_parquet(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    base: str | None = None,
    merge_schema: bool = False,
) -> DataFrame | None:
    """A parquet read, or None if nothing is at ``path``. Every other error is raised."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if base:
        reader = reader.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class EventLake:
    """Scans of the raw lake, limited to the folders of the run dates.

    ``drifting`` says that a column's type may differ from the declared one on some days.
    """

    spark: SparkSession
    root: str
    drifting: bool = False

    def feed_root(self, segment_type: str, platform: str) -> str:
        source = SOURCE_IDS.get(platform, SOURCE_IDS[FALLBACK_PLATFORM])
        return f"{self.root.rstrip('/')}/{source}/segment_type={segment_type}"

    def _tagged(self, rows: DataFrame, platform: str) -> DataFrame:
        folder_day = F.concat_ws(
            "-",
            F.col("year").cast("string"),
            F.lpad(F.col("month").cast("string"), 2, "0"),
            F.lpad(F.col("day").cast("string"), 2, "0"),
        )
        return rows.withColumns({PLATFORM: F.lit(platform), RUN_DATE: folder_day}).drop("year", "month", "day")

    def scan(self, segment_type: str, platform: str, days: list[date], declared: StructType | None = None) -> Slice | None:
        """One scan over all the days; a column that some day lacks reads as NULL there.

        With a declared schema no file is opened before the rows are wanted. Without one, the footers of all files are.
        """
        base = self.feed_root(segment_type, platform)
        if declared is not None:
            declared = self._with_day(declared)
        rows = read_parquet(self.spark, days_glob(base, days), declared, base, merge_schema=declared is None)
        return None if rows is None else Slice(self._tagged(rows, platform), (platform,))

    def _with_day(self, schema: StructType) -> StructType:
        schema = StructType(schema.fields)  # add() changes a schema in place
        for part in ("year", "month", "day"):
            schema = schema.add(part, "string")
        return schema

    def _day_schema(self, base: str, day: date) -> StructType | None:
        """The schema of one file of a day: the files of a day are one load's and have the same columns."""
        rows = read_parquet(self.spark, f"{base}/{day_folder(day)}")
        return None if rows is None else rows.schema

    def scan_by_schema(self, segment_type: str, platform: str, days: list[date]) -> list[Slice]:
        """One scan per distinct schema among the days.

        Defaults that are not NULL apply only to days whose files lack the column, so days
        with and without it must not be merged.
        """
        base = self.feed_root(segment_type, platform)
        wanted = sorted(set(days))
        # One footer a day; only the schemas come here.
        with ThreadPoolExecutor(SCHEMA_READS) as pool:
            schemas = list(pool.map(lambda day: self._day_schema(base, day), wanted))
        by_schema: dict[tuple, list[date]] = defaultdict(list)
        for day, schema in zip(wanted, schemas, strict=True):
            if schema is not None:
                by_schema[tuple(sorted((column.name, column.dataType.json()) for column in schema))].append(day)
        found = dict(zip(wanted, schemas, strict=True))
        slices = []
        for same in by_schema.values():
            rows = read_parquet(self.spark, days_glob(base, same), self._with_day(found[same[0]]), base)
            slices.append(Slice(self._tagged(rows, platform), (platform,)))
        return slices

    def _scan_merged(self, segment_type: str, platform: str, days: list[date]) -> list[Slice]:
        """One scan, or one per schema where a column's type differs between days."""
        try:
            merged = self.scan(segment_type, platform, days)
        except (PySparkException, Py4JJavaError) as error:  # the footer job's failure comes unconverted
            if "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            return self.scan_by_schema(segment_type, platform, days)
        return [merged] if merged else []

    def _scan_declared(self, feed, segment_type: str, platform: str, days: list[date]) -> list[Slice] | None:
        """One scan by the feed's declared schema; None if the latest day's files are not as declared."""
        base, declared = self.feed_root(segment_type, platform), raw_schema(feed.reads)
        latest = next((found for day in sorted(days, reverse=True) if (found := self._day_schema(base, day))), None)
        if latest is None:
            return []
        if not as_declared(latest, declared, feed.nulls):
            return None
        return [self.scan(segment_type, platform, days, declared)]

    def slices(self, feed, days: list[date]) -> list[Slice]:
        """The raw rows of a feed on the days, missing platforms left out.

        Feeds whose defaults depend on what files have are scanned by schema, from one footer a day. All others are
        scanned by their declared schema once one file shows that it holds; where it does not, or the lake is
        ``drifting``, the footers of all files decide.
        """
        found: list[Slice] = []
        for platform in feed.platforms:
            segment_type = feed.segment_type_on(platform)
            if feed.needs_column_presence:
                found += self.scan_by_schema(segment_type, platform, days)
                continue
            declared = self._scan_declared(feed, segment_type, platform, days) if feed.reads and not self.drifting else None
            found += self._scan_merged(segment_type, platform, days) if declared is None else declared
        return found


def load_users(spark: SparkSession, path: str) -> DataFrame:
    """The user dimension, pruned to the two columns the jobs join on."""
    return spark.read.parquet(path).select("user_key", "user_id")
