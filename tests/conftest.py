from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripweave.session import apply_defaults  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tripweave-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_defaults(session)
    session.stop()


@pytest.fixture()
def rows(spark):
    """Build a frame from a DDL schema and tuples, and read frames back as sorted tuples."""
    class Rows:
        @staticmethod
        def of(schema: str, *values: tuple):
            return spark.createDataFrame(list(values), schema)

        @staticmethod
        def back(frame, *columns: str) -> list[tuple]:
            chosen = frame.select(*columns) if columns else frame
            return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return Rows
