import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from beatlake.session import build_session  # noqa: E402


def plain_session():
    """A session as others make it, for running the queries under Spark's own settings."""
    return SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = plain_session() if os.environ.get("CHECK_PLAIN_SESSION") else build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    saved = {}

    def change(**settings):
        for name, value in settings.items():
            name = name.replace("__", ".")
            saved[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield change
    for name, value in saved.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
