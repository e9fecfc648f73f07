"""Numeric and categorical summaries of trip messages, per micro-batch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripweave.fixed_values import STREAM_CATEGORY_ATTRIBUTES, STREAM_NUMERIC_ATTRIBUTES
from tripweave.operators.aggregates import counts_of_columns, unpivot_measures
from tripweave.operators.filters import message_box
from tripweave.schemas import TRIP_MESSAGE
from tripweave.sinks.summaries import DONE, OPEN, mark_batch, write_batch
from tripweave.streaming.messages import decode_messages
from tripweave.streaming.runner import run_batches


def numeric_summary(
    decoded: DataFrame, keep: Column, attributes: Sequence[str] = STREAM_NUMERIC_ATTRIBUTES,
) -> DataFrame:
    """Minimum, maximum, mean and population deviation of each attribute, from one pass.

    ``elements`` counts all messages, the statistics and ``elements_after_filter`` only those
    that pass ``keep``; broken messages are counted apart in ``corrupt``. No message after the
    filter, no rows.
    """
    sound = ~F.col("is_corrupt")
    passes = sound & F.coalesce(keep, F.lit(False))
    measures = {"min": F.min, "max": F.max, "mean": F.avg, "stddev_pop": F.stddev_pop}
    wide = decoded.agg(
        F.count_if(sound).alias("elements"),
        F.count_if(passes).alias("elements_after_filter"),
        F.count_if(~sound).alias("corrupt"),
        *[
            measure(F.when(passes, F.col(attribute))).alias(f"{attribute}__{name}")
            for attribute in attributes for name, measure in measures.items()
        ],
    ).where(F.col("elements_after_filter") > 0)
    return unpivot_measures(
        wide, attributes, list(measures), ("elements", "elements_after_filter", "corrupt"),
    )


def category_counts(
    decoded: DataFrame, keep: Column, attributes: Sequence[str] = STREAM_CATEGORY_ATTRIBUTES,
) -> DataFrame:
    """Messages after the filter per attribute and category, one row each."""
    return counts_of_columns(decoded.where(~F.col("is_corrupt") & keep), attributes)


def category_lists(
    counts: DataFrame, cut: Mapping[str, int] | None = None, order: str = "asc",
) -> DataFrame:
    """One row per attribute with parallel lists of categories and counts, sorted by count
    and then category. ``cut`` keeps the first N of an attribute.

    A list holds one entry per distinct category, never one per message; for attributes with
    many categories give a cut, or use the counts as they are.

    The cut is a ranked filter, which Spark applies before the shuffle too, so a station list
    of any length reaches the list builder as N rows.
    """
    if order not in ("asc", "desc"):
        raise ValueError("order is 'asc' or 'desc'")
    weight = F.col("count") if order == "asc" else -F.col("count")
    whole, pieces = counts, []
    for attribute, size in (cut or {}).items():
        rank = F.row_number().over(Window.partitionBy("attribute").orderBy(weight, "category"))
        cut_rows = counts.where(F.col("attribute") == attribute)
        pieces.append(cut_rows.withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_rank"))
        whole = whole.where(F.col("attribute") != attribute)
    for piece in pieces:
        whole = whole.unionByName(piece)
    entry = F.struct(
        weight.alias("weight"), F.col("category").alias("category"), F.col("count").alias("count"),
    )
    lists = whole.groupBy("attribute").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    return lists.select(
        "attribute",
        F.col("_entries.category").alias("categories"),
        F.transform("_entries", lambda e: e["count"].cast("double")).alias("values"),
    )


def start_summaries(
    messages: DataFrame,
    numeric_path: str,
    category_path: str,
    checkpoint: str,
    station_cut: int,
    keep: Column | None = None,
    order: str = "asc",
    every_seconds: float | None = None,
    counts_path: str | None = None,
    other_cut: int = 1000,
    commits_path: str | None = None,
) -> StreamingQuery:
    """Add a numeric and a categorical summary of every micro-batch to two Parquet tables.

    Each batch is summarised on its own and stamped with the processing time. The count of every
    category goes to a long table of its own (``counts_path``, by default ``-counts`` after the
    categorical path). The lists are a report over it: the first ``station_cut`` start stations
    and the first ``other_cut`` categories of any other attribute.

    The three tables are written one after the other. A record per batch (``commits_path``, by default
    ``-commits`` after the numeric path) tells when all are there: ``read_committed`` shows of a
    batch all tables or none, also after a failure between them.
    """
    keep = message_box() if keep is None else keep
    decoded = decode_messages(messages, TRIP_MESSAGE)
    long_path = counts_path or f"{category_path.rstrip('/')}-counts"
    commits = commits_path or f"{numeric_path.rstrip('/')}-commits"
    cut = {name: other_cut for name in STREAM_CATEGORY_ATTRIBUTES} | {"start_station_id": station_cut}

    def summarise(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            mark_batch(batch, commits, batch_id, OPEN)
            stamp = F.lit(datetime.now(timezone.utc)).alias("timestamp")  # one for all tables
            numbers = numeric_summary(batch, keep).select("*", stamp)
            write_batch(numbers, numeric_path, batch_id)
            elements = batch.agg(F.count_if(~F.col("is_corrupt")).alias("elements")).scalar()
            counts = category_counts(batch, keep)
            # The lists start from the counts as written, a row per category, not from the messages again.
            written = write_batch(counts.select("*", stamp), long_path, batch_id)
            counted = batch.sparkSession.read.schema(counts.schema).parquet(written)
            lists = category_lists(counted, cut, order)
            write_batch(
                lists.select("attribute", stamp, elements.alias("elements"), "categories", "values"),
                category_path, batch_id,
            )
            mark_batch(batch, commits, batch_id, DONE)
        finally:
            batch.unpersist()

    return run_batches(decoded, summarise, checkpoint, every_seconds)
