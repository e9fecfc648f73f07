"""Kafka sources. They need Spark's own Kafka connector package on the class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """One topic as a streaming frame of text ``key`` and ``value``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return _as_text(reader.load())


def kafka_batch(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest",
) -> DataFrame:
    """Everything the topic holds now, as text ``key`` and ``value``."""
    return _as_text(
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )


def _as_text(records: DataFrame) -> DataFrame:
    return records.selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
