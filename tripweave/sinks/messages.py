"""Rows as JSON messages, to a topic or to text files that a file stream can read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_messages(rows: DataFrame) -> DataFrame:
    """One JSON text ``value`` per row, holding every column."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def keyed_json_messages(
    rows: DataFrame,
    key: str | Column = "time",
    fields: Sequence[str] = ("duration", "visibility"),
) -> DataFrame:
    """Text ``key`` and a JSON ``value`` of the chosen fields."""
    key_column = F.col(key) if isinstance(key, str) else key
    return rows.select(
        key_column.cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Send ``value`` (and ``key``, if there) to a topic; every executor sends its own rows."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def write_message_files(messages: DataFrame, path: str) -> None:
    """Add the messages to a folder of text files, one message per line."""
    messages.select("value").write.mode("append").text(path)
