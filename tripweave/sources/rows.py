"""Small literal tables with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def append_rows(table: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """The table followed by hand-made rows of the same schema."""
    return table.unionByName(literal_rows(table.sparkSession, rows, table.schema))
