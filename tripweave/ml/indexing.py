"""Numbers for the labels of a column, for any number of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripweave.sinks.files import store


def fit_index(rows: DataFrame, column: str) -> DataFrame:
    """``column, index``: the labels numbered from 0, most frequent first, equal counts by label.

    The labels are counted, dealt out by ranges of (count, label), sorted inside the ranges and numbered by
    the ranges' sizes. No task or driver holds the list; the only thing ordered as a whole is one number
    per range. Null is no label.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    ranked = store(
        counts.orderBy(F.desc("_n"), F.asc(column)).select(column, F.monotonically_increasing_id().alias("_at")), "label-ranks")
    range_of = F.shiftright("_at", 33)  # such an id holds the partition above the place in it
    sizes = ranked.groupBy(range_of.alias("_range")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_range").alias("_start_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    place = F.col("_at") - F.shiftleft(range_of, 33)
    numbered = ranked.join(starts, range_of == F.col("_start_of"))
    return numbered.select(column, (F.col("_start") + place).cast("double").alias("index"))


def apply_index(rows: DataFrame, index: DataFrame, column: str, output: str) -> DataFrame:
    """The rows with the number of their label; labels without one, and null, get the next free number.

    The index is broadcast only while Spark finds it under its own size threshold.
    """
    free = index.agg(F.coalesce(F.max("index") + 1, F.lit(0.0)).alias("free")).scalar()
    named = index.select(F.col(column).alias("_label"), F.col("index").alias("_index"))
    joined = rows.join(named, rows[column] == named["_label"], "left")
    return joined.withColumn(output, F.coalesce("_index", free)).drop("_label", "_index")
