"""Summary tables fed by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERY_ID = "sql.streaming.queryId"
_NO_STREAM = "batch"


def write_batch(rows: DataFrame, path: str, batch_id: int, run_id: str | None = None) -> str:
    """Write the rows of one micro-batch under its own ``run_id`` and ``batch_id`` folder, and return the folder.

    The run is named by the id that the stream's checkpoint holds: it stays over restarts and is
    new for a new checkpoint. So a batch that is run again after a failure replaces its folder,
    and several runs add up in one table. Outside a stream the caller may name the run.
    """
    run = run_id or rows.sparkSession.sparkContext.getLocalProperty(_QUERY_ID) or _NO_STREAM
    folder = f"{path}/run_id={run}/batch_id={batch_id}"
    rows.write.mode("overwrite").parquet(folder)
    return folder


OPEN, DONE = "open", "done"


def mark_batch(batch: DataFrame, path: str, batch_id: int, state: str, run_id: str | None = None) -> None:
    """Record that the tables of a micro-batch are being written, or are all there.

    A batch feeds several tables, one after the other. Its record is ``open`` from before the first is
    touched, also where the batch is run again, to after the last.
    """
    write_batch(batch.sparkSession.range(1).select(F.lit(state).alias("state")), path, batch_id, run_id)


def read_committed(spark: SparkSession, path: str, commits_path: str) -> DataFrame:
    """A table's rows of the batches whose tables are all there: of one batch all tables or none."""
    done = spark.read.parquet(commits_path).where(F.col("state") == DONE).select("run_id", "batch_id")
    return spark.read.parquet(path).join(done, ["run_id", "batch_id"], "left_semi")
