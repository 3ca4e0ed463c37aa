"""Command line: ``spark-submit … -m beatlake JOB_OR_GROUP… --dates a::b --lake … --processed …``."""

from __future__ import annotations

import argparse

from beatlake.operators.merge import BucketedTarget, ParquetTarget
from beatlake.plans.model import Job
from beatlake.plans.registry import jobs_named
from beatlake.plans.runs import Run, run_jobs
from beatlake.session import build_session
from beatlake.sources.dates import run_dates


def main() -> None:
    parser = argparse.ArgumentParser(prog="beatlake", description="Build and publish event tables.")
    parser.add_argument("names", nargs="*", help="jobs or groups")
    parser.add_argument("--dates", default="yesterday", help="yesterday, a day, a,b,c or a::b")
    parser.add_argument("--lake", required=True, help="root of the raw event lake")
    parser.add_argument("--processed", required=True, help="folder of the day tables")
    parser.add_argument("--warehouse", help="folder of the published tables; merges the days if given")
    parser.add_argument("--database", help="catalog database of published tables bucketed by key; merges the days")
    parser.add_argument("--buckets", type=int, default=512, help="buckets of a new table in the database")
    parser.add_argument("--keep-null-keys", action="store_true", help="publish rows without a key, again on each run")
    parser.add_argument("--users", help="parquet of the user dimension; replaces the exported one first")
    parser.add_argument("--at-once", type=int, default=4, help="jobs that run at the same time")
    options = parser.parse_args()
    if options.warehouse and options.database:
        parser.error("--warehouse and --database exclude each other")

    jobs = jobs_named(options.names)
    spark = build_session(**{"spark.scheduler.mode": "FAIR"})
    run = Run(spark, options.lake, options.processed, tuple(run_dates(options.dates)))
    if options.users:
        run.export_users(spark.read.parquet(options.users))

    def work(job: Job) -> None:
        late = run.process(job)
        if options.warehouse:
            target = ParquetTarget(spark, f"{options.warehouse.rstrip('/')}/{job.name}")
        elif options.database:
            target = BucketedTarget(spark, f"{options.database}.{job.name}", job.key, options.buckets)
        else:
            return
        run.publish(job, target, late, options.keep_null_keys)

    run_jobs(spark, jobs, work, options.at_once)


if __name__ == "__main__":
    main()
