"""Counts, shares, profiles and modes. All combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("count"))


def counts_by(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, in no order."""
    return rows.groupBy(*keys).agg(F.count("*").alias("count"))


def counts_of_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per (``attribute``, ``category``) of several text columns, in one pass and one
    shuffle instead of one per column.
    """
    cells = [cell for name in columns for cell in (F.lit(name), F.col(name))]
    unpivoted = rows.select(F.stack(F.lit(len(columns)), *cells).alias("attribute", "category"))
    return counts_by(unpivoted, "attribute", "category")


def usage_counts(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key, most used first; equal counts go by key."""
    return counts_by(rows, key).orderBy(F.desc("count"), F.asc(key))


def top_counts(rows: DataFrame, key: str, size: int, order: str = "desc") -> DataFrame:
    """The ``size`` most used keys, or the least used with ``order='asc'``."""
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    by_count = F.desc("count") if order == "desc" else F.asc("count")
    return counts_by(rows, key).orderBy(by_count, F.asc(key)).limit(size)


def class_shares(rows: DataFrame, key: str) -> DataFrame:
    """Rows per key with their share of all rows.

    The total is a scalar subquery over the same counts (Spark reuses their shuffle), so no
    window has to bring all keys into one task.
    """
    counts = counts_by(rows, key)
    total = counts.select(F.sum("count")).scalar()
    return counts.select(key, "count", (F.col("count") / total).alias("share"))


def numeric_profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and sample deviation of each column, all from one scan."""
    return unpivot_measures(rows.agg(*spread_of(columns)), columns, list(SPREAD))


SPREAD = {"min": F.min, "max": F.max, "mean": F.avg, "stddev_samp": F.stddev_samp}


def spread_of(columns: Sequence[str]) -> list[Column]:
    """The measures of each column as aggregates named ``column__measure``."""
    return [
        measure(F.col(column).cast("double")).alias(f"{column}__{name}")
        for column in columns for name, measure in SPREAD.items()
    ]


def unpivot_measures(
    wide: DataFrame, columns: Sequence[str], measures: Sequence[str], kept: Sequence[str] = (),
) -> DataFrame:
    """From columns named ``column__measure`` to one row per column."""
    cells: list[Column] = []
    for column in columns:
        cells.append(F.lit(column))
        cells += [F.col(f"{column}__{name}") for name in measures]
    return wide.select(
        *kept, F.stack(F.lit(len(columns)), *cells).alias("attribute", *measures),
    )


def daily_totals(trips: DataFrame, time: str = "time", duration: str = "duration") -> DataFrame:
    """Total duration, mean month and trips of each day of the year."""
    return trips.groupBy(F.dayofyear(time).alias("dayofyear")).agg(
        F.sum(duration).alias("total_duration"),
        F.avg(F.month(time)).alias("month"),
        F.count(time).alias("count"),
    )


def daily_counts(trips: DataFrame, time: str = "time") -> DataFrame:
    return trips.groupBy(F.dayofyear(time).alias("dayofyear")).agg(F.count("*").alias("count"))


def group_mode(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key; the lowest on ties, null where a key has only nulls.

    Counting (key, value) first keeps the state to one row per pair, spreads a hot key over
    its values, and stays in hash aggregation; the pick then runs over those counts.
    """
    pairs = rows.groupBy(*keys, column).agg(F.count("*").alias("_n"))
    return pairs.groupBy(*keys).agg(mode_of_counts(F.col(column), F.col("_n")).alias(column))


def mode_of_counts(value: Column, count: Column) -> Column:
    """Aggregate picking the most frequent value from pre-counted values."""
    ranked = F.when(value.isNotNull(), F.struct((-count).alias("n"), value.alias("value")))
    return F.min(ranked)["value"]
