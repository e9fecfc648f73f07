"""File scans. Paths may be globs, so monthly folders read as one table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    separator: str = ",",
    comment: str | None = "#",
) -> DataFrame:
    """CSV with a header line; every column is text and commented lines are skipped.

    With a schema (which must list the whole header) planning reads no file. Without one only
    a header is read; types are never inferred. Either way each file's header is checked, so
    a file with other columns is an error and never read by position.
    """
    reader = (
        spark.read.option("header", True).option("sep", separator).option("enforceSchema", False)
    )
    if comment is not None:
        reader = reader.option("comment", comment)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_declared(spark: SparkSession, path: str | list[str], schema: StructType, **options) -> DataFrame:
    """The declared columns of CSV files that may hold more, found by the header's names and
    cast to the declared types; a missing column is an error that names it."""
    table = read_csv(spark, path, **options)
    missing = [name for name in schema.names if name not in table.columns]
    if missing:
        raise ValueError(f"columns not in the header: {', '.join(missing)}")
    return table.select(*[
        F.col(f"`{field.name}`").try_cast(field.dataType).alias(field.name) for field in schema])


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet scan; filters and column selection reach the files through Catalyst."""
    return spark.read.parquet(*paths)
