"""Summaries of trip messages by windows of event time, over all micro-batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripweave.fixed_values import STREAM_NUMERIC_ATTRIBUTES
from tripweave.operators.aggregates import unpivot_measures
from tripweave.operators.filters import message_box
from tripweave.schemas import TIMED_TRIP_MESSAGE
from tripweave.sinks.summaries import write_batch
from tripweave.streaming.messages import decode_messages
from tripweave.streaming.runner import run_batches

MODES = ("append", "update", "complete")
_MEASURES = {"min": F.min, "max": F.max, "mean": F.avg, "stddev_pop": F.stddev_pop}


def windowed_summary(
    decoded: DataFrame, keep: Column, time: str = "start_date", size: str = "1 hour",
    slide: str | None = None, delay: str = "1 day", attributes: Sequence[str] = STREAM_NUMERIC_ATTRIBUTES,
) -> DataFrame:
    """Messages that pass ``keep`` and the spread of each attribute, per window of their own time.

    Windows are ``size`` long and, with ``slide``, overlap. The state holds one row of sums per open
    window, whatever the number of messages. On a stream a window is final, and forgotten, once a
    message ``delay`` after its end was seen; messages for it that come later still are left out. Broken messages
    and those without a time have no window. A batch frame gives the same table at once.
    """
    passes = decoded.where(~F.col("is_corrupt") & F.coalesce(keep, F.lit(False)) & F.col(time).isNotNull())
    if decoded.isStreaming:
        passes = passes.withWatermark(time, delay)
    window = F.window(time, size, slide) if slide else F.window(time, size)
    wide = passes.groupBy(window.alias("_window")).agg(
        F.count("*").alias("elements_after_filter"),
        *[
            measure(attribute).alias(f"{attribute}__{name}")
            for attribute in attributes for name, measure in _MEASURES.items()
        ],
    )
    timed = wide.withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
    return unpivot_measures(
        timed, attributes, list(_MEASURES), ("window_start", "window_end", "elements_after_filter"))


def start_windowed_summary(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    size: str = "1 hour",
    slide: str | None = None,
    delay: str = "1 day",
    mode: str = "append",
    time: str = "start_date",
    keep: Column | None = None,
    every_seconds: float | None = None,
    schema: StructType = TIMED_TRIP_MESSAGE,
) -> StreamingQuery:
    """Write the windows of a message stream to a Parquet table, by run and batch.

    ``append`` writes each window once, when it is final; ``update`` writes those that a batch changed;
    ``complete`` writes all of them with every batch and never forgets one, so its state grows with
    the windows. ``current_windows`` reads any of the three. State and table survive a restart
    from the same checkpoint; a batch that is run again replaces its rows.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    keep = message_box() if keep is None else keep
    windows = windowed_summary(decode_messages(messages, schema), keep, time, size, slide, delay)
    return run_batches(
        windows, lambda batch, batch_id: write_batch(batch, path, batch_id), checkpoint, every_seconds, mode)


def current_windows(written: DataFrame) -> DataFrame:
    """The last state of each run's windows in a table that ``start_windowed_summary`` wrote."""
    key = ["run_id", "window_start", "window_end", "attribute"]
    values = [name for name in written.columns if name not in (*key, "batch_id")]
    last = written.groupBy(*key).agg(F.max(F.struct("batch_id", *values)).alias("_last"))
    return last.select(*key, *[F.col("_last")[name].alias(name) for name in values])


def late_rows(query: StreamingQuery) -> int:
    """Messages that came after their window was final, by the progress reports that Spark still holds."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress for operator in progress.stateOperators)
