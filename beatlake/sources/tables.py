"""Published day tables: partitioned writes, snapshots and staged reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from beatlake.sources.dates import day_folder, days_glob, folder_day
from beatlake.sources.lake import INPUT_DAY, read_parquet

DAY_COLUMNS = ("year", "month", "day")
NOTE = f"folder string, {INPUT_DAY} string"


def _by_day(rows: DataFrame) -> DataFrame:
    """Rows gathered by day into files of the advisory size.

    Adaptive execution splits big days over many tasks and joins small ones, whatever the number
    of upstream tasks was.
    """
    return rows.hint("rebalance", *DAY_COLUMNS)


def _write(rows: DataFrame, path: str, parts: Sequence[str] = DAY_COLUMNS) -> None:
    """Replaces the partitions that the rows have and no others."""
    rows.write.partitionBy(*parts).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_days(rows: DataFrame, path: str) -> None:
    """Replace the day partitions that ``rows`` contains and leave the others alone.

    Days come from the event times, so a late event replaces its whole older day; see ``write_run_days``.
    """
    _write(_by_day(rows), path)


def _folder(names: Sequence[str]) -> Column:
    """The folder under a table that a row is written to."""
    values = (F.coalesce(F.col(name).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")) for name in names)
    return F.concat_ws("/", *(F.concat(F.lit(f"{name}="), value) for name, value in zip(names, values)))


def _notes(path: str) -> str:
    """Where a table keeps which folders each input day wrote; hidden from readers of the table."""
    return f"{path.rstrip('/')}/_written"


def _removed(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_run_days(rows: DataFrame, path: str, days: Sequence[date]) -> list[date]:
    """Replace all that the run's input days wrote before, in whatever event days it lies, and nothing else.

    ``rows`` has its event day in the day columns and the input day it was loaded from in ``INPUT_DAY``. Both are
    partitions, so runs of different input days never touch the same files: late rows stand beside the rows of
    their day and survive its reruns. The job is computed and written once. Which folders an input day wrote is
    noted beside the table, so that a rerun finds those it no longer fills without listing the table. Returns the
    event days other than the input days that got rows.
    """
    spark = rows.sparkSession
    names = [*DAY_COLUMNS, INPUT_DAY]
    labels = sorted({day.isoformat() for day in days})
    of_days = f"{{{','.join(f'{INPUT_DAY}={label}' for label in labels)}}}"
    noted = read_parquet(spark, f"{_notes(path)}/{of_days}", StructType.fromDDL(NOTE), _notes(path))
    # A few folders an input day, there and below: its own event day, and those of its late rows.
    before = set() if noted is None else {row.folder for row in noted.where("folder IS NOT NULL").collect()}
    seen = Observation()
    gathered = rows.hint("rebalance", *names).observe(seen, F.collect_set(_folder(names)).alias("folders"))
    _write(gathered, path, names)
    written = set(seen.get.get("folders") or ())
    for folder in sorted(before - written):
        _removed(spark, f"{path.rstrip('/')}/{folder}")
    note = [(None, label) for label in labels] + [(folder, folder.rsplit("=", 1)[1]) for folder in sorted(written)]
    _write(spark.createDataFrame(note, NOTE).coalesce(1), _notes(path), [INPUT_DAY])
    touched = {folder.rsplit("/", 1)[0] for folder in written} - {day_folder(day) for day in days}
    return sorted(found for folder in touched if (found := folder_day(folder)))


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Replace the whole table, as for the daily export of a dimension or a stage reload."""
    rows.write.mode("overwrite").parquet(path)


def read_days(spark: SparkSession, path: str, days: list[date], columns: Sequence[str] = ("*",)) -> DataFrame | None:
    """The listed columns of the day partitions; None if no day exists."""
    rows = read_parquet(spark, days_glob(path, days), base=path)
    return None if rows is None else rows.select(*columns)
