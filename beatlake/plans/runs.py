"""Runs: build jobs over run dates, write their day tables, publish them by merge."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatlake.operators.combine import union_present
from beatlake.operators.merge import merge
from beatlake.plans.model import Job
from beatlake.plans.registry import DUPLICATE_KEY_JOBS
from beatlake.sources.lake import EventLake, load_users
from beatlake.sources.tables import read_days, write_run_days, write_snapshot

TYPE_MISMATCH = "PARQUET_COLUMN_DATA_TYPE_MISMATCH"


@dataclass(frozen=True)
class Run:
    """A set of run dates over a raw lake and a folder of processed tables.

    ``processed/dim_user`` holds the user dimension and ``processed/<job>`` the day tables. Two runs of one
    job and input day must not overlap; a run that failed half-way is simply run again.
    """

    spark: SparkSession
    lake_root: str
    processed_root: str
    days: tuple[date, ...]

    def path(self, table: str) -> str:
        return f"{self.processed_root.rstrip('/')}/{table}"

    def export_users(self, users: DataFrame) -> None:
        """Replace the user dimension the jobs join."""
        write_snapshot(users, self.path("dim_user"))

    def build(self, job: Job, tagged: bool = False, drifting: bool = False) -> DataFrame | None:
        """The job's rows for all run dates as one plan; None if no input exists."""
        lake = EventLake(self.spark, self.lake_root, drifting)
        users = load_users(self.spark, self.path("dim_user")) if job.needs_users else None
        return job.build(lambda feed: lake.slices(feed, list(self.days)), users, tagged)

    def process(self, job: Job) -> list[date]:
        """Write the job's day table; without input nothing is written.

        A run replaces what its input days wrote before. Through late events that lies now and then in older days,
        beside what other input days brought; those days are returned. A file that turns out to differ from the
        declared types makes the run read all footers and start again.
        """
        rows = self.build(job, tagged=True)
        if rows is None:
            return []
        try:
            return write_run_days(rows, self.path(job.name), self.days)
        except (PySparkException, Py4JJavaError) as error:
            if TYPE_MISMATCH not in str(error):
                raise
            return write_run_days(self.build(job, tagged=True, drifting=True), self.path(job.name), self.days)

    def staged(self, job: Job, late_days: Sequence[date] = ()) -> DataFrame | None:
        """The run dates' rows of a day table as published, whichever input days brought them."""
        days = [*self.days, *late_days]
        if hasattr(job, "staged"):
            rows = read_days(self.spark, self.path(job.name), days)
            return None if rows is None else job.staged(rows)
        return read_days(self.spark, self.path(job.name), days, job.column_list)

    def publish(self, job: Job, target, late_days: Sequence[date] = (), keep_null_keys: bool = False) -> None:
        """Add the run dates' rows that the published table lacks.

        The staged days go straight into the merge: the table is only read and appended to.
        """
        stage = self.staged(job, late_days)
        if stage is not None:
            merge(stage, target, job.key, job.sort_key, job.name in DUPLICATE_KEY_JOBS, keep_null_keys)


def run_jobs(spark: SparkSession, jobs: Iterable[Job], work: Callable[[Job], None], at_once: int = 4) -> None:
    """``work`` for every job, a few at a time, each in a scheduler pool of its own.

    A job that fails leaves the others to finish; the failures are raised together at the end, named by job.
    """

    def one(job: Job) -> Exception | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.name)
        try:
            work(job)
        except Exception as error:
            error.add_note(f"job {job.name}")
            return error
        return None

    with ThreadPoolExecutor(at_once) as pool:
        failures = [error for error in pool.map(one, jobs) if error]
    if failures:
        raise ExceptionGroup("jobs failed", failures)


def row_counts(built: Iterable[tuple[str, DataFrame | None]]) -> DataFrame | None:
    """Rows of each built job, in one plan; jobs without input have none."""
    return union_present(
        rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("job"), "rows")
        for name, rows in built
        if rows is not None
    )
