"""Model scoring of JSON rows as they arrive."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tripweave.ml.models import regression_metrics, score
from tripweave.schemas import CITY_MESSAGE
from tripweave.sinks.summaries import write_batch
from tripweave.streaming.messages import decode_messages
from tripweave.streaming.runner import run_batches


def _incomplete(schema: StructType, label: str) -> Column:
    """A field that the model reads is missing; the label may be."""
    missing = [F.col(field.name).isNull() for field in schema if field.name != label]
    return reduce(lambda a, b: a | b, missing, F.lit(False))


def _predicted(decoded: DataFrame, model: PipelineModel, schema: StructType, label: str) -> DataFrame:
    sound = decoded.where(~F.col("is_corrupt") & ~_incomplete(schema, label))
    return score(model, sound.drop("is_corrupt"))


def score_messages(
    messages: DataFrame, model: PipelineModel, schema: StructType = CITY_MESSAGE, label: str = "label",
) -> DataFrame:
    """Predictions for all sound messages that have every model input, labelled or not; the
    model is loaded once, not per batch."""
    return _predicted(decode_messages(messages, schema), model, schema, label)


def start_scoring(
    messages: DataFrame,
    model: PipelineModel,
    predictions_path: str,
    metrics_path: str,
    checkpoint: str,
    schema: StructType = CITY_MESSAGE,
    every_seconds: float | None = None,
    label: str = "label",
) -> StreamingQuery:
    """Write the predictions of every micro-batch, and its R2 and RMSE, to two tables.

    The metrics are over the ``n`` labelled predictions. Beside them stand the messages that
    were predicted without a label (``unlabelled``) and those without a prediction: ``corrupt``
    text, and sound messages with a model input missing (``incomplete``).
    """
    unusable = _incomplete(schema, label)
    sound = ~F.col("is_corrupt")
    tallies = {
        "unlabelled": sound & ~unusable & F.col(label).isNull(),
        "corrupt": F.col("is_corrupt"),
        "incomplete": sound & unusable,
    }

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            predictions = _predicted(batch, model, schema, label).drop("features")
            write_batch(predictions, predictions_path, batch_id)
            tally = batch.agg(F.struct(*[F.count_if(rule).alias(name) for name, rule in tallies.items()]).alias("tally"))
            metrics = regression_metrics(predictions, label).withColumn("_tally", tally.scalar())
            counted = metrics.select("n", "r2", "rmse", *[F.col(f"_tally.{name}").alias(name) for name in tallies])
            any_message = reduce(lambda a, b: a + b, [F.col(name) for name in ("n", *tallies)]) > 0
            write_batch(counted.where(any_message), metrics_path, batch_id)
        finally:
            batch.unpersist()

    return run_batches(decode_messages(messages, schema), handle, checkpoint, every_seconds)
