"""Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.session import shared_folder


def write_parquet(
    table: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write the table; an existing path is an error unless another mode is asked for.

    Partition columns let later reads skip folders (say, by month). The rows are brought
    together by them first, or every task would add a file to every folder; a partition much
    larger than the others is split over several tasks at run time.
    """
    if partition_by:
        rows = table.hint("rebalance", *partition_by)
        rows.write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        table.write.mode(mode).parquet(path)


def write_by_day(table: DataFrame, time: str, path: str, day: str = "start_day", mode: str = "errorifexists") -> None:
    """Write the table in one folder per date of its time column; filters on ``day`` skip folders."""
    write_parquet(table.withColumn(day, F.to_date(time)), path, mode, [day])


def write_bucketed(table: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write the table in buckets of its key columns under a name of the catalog, and return it as read.

    Joins and counts on all of the keys then need no shuffle of this table. A bucket is read by one task, so
    choose the number for the size of the table, and leave keys that hold a large share of its rows to plain
    tables, whose joins Spark splits at run time. The files lie under ``path``, else in the warehouse.
    """
    # Rows meet by bucket first: one file per bucket instead of one per task and bucket.
    rows = table.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys)
    (rows if path is None else rows.option("path", path)).saveAsTable(name)
    return table.sparkSession.table(name)


def store(table: DataFrame, purpose: str) -> DataFrame:
    """The table, written once to the shared folder and read from there.

    For results that several later steps start from: they are computed once, and a lost
    executor costs a re-read rather than a replay of everything before.
    """
    path = shared_folder(table.sparkSession, purpose)
    write_parquet(table, path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
