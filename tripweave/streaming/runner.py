"""Starting micro-batch queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    every_seconds: float | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` per micro-batch.

    ``output_mode`` matters for streams with state, such as windows: which of its rows a batch holds.

    With an interval a batch starts every so many seconds until stopped; without one the
    query works off what is there and ends. The checkpoint lets a restart go on where the
    last run stopped.
    """
    writer = stream.writeStream.outputMode(output_mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    if every_seconds is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{round(every_seconds * 1000)} milliseconds")
    return writer.start()


def wait(query: StreamingQuery, timeout_seconds: float | None = None) -> bool:
    """Wait for the end of the query (or the timeout); errors of the query are raised."""
    if timeout_seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout_seconds))
