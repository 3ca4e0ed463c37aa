"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Event days are calendar days in UTC, and partition values such as month=01 stay text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Recording the call site of each of a job's many column expressions takes longer than its plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "beatlake", **extra: str) -> SparkSession:
    """A session with the settings above; master and sizes come from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="beatlake-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only where none is named and all runs in one process (tests) is it a temporary one, kept for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir has to name a folder that all executors of {master} share")
    return _own_folder(spark.sparkContext.applicationId)
