"""JSON text messages to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BROKEN = "_broken"


def text_stream(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None,
) -> DataFrame:
    """A folder of message files, one JSON text ``value`` per line, as a stream."""
    reader = spark.readStream.format("text")
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.load(path)


def decode_messages(
    messages: DataFrame, schema: T.StructType, value: str = "value", kept: tuple[str, ...] = (),
) -> DataFrame:
    """The declared fields of each message, with ``is_corrupt`` for text that is not JSON.

    Every field is first read as text, so quoted and bare numbers both count, and then cast;
    a field that does not parse is null.
    """
    as_text = T.StructType(
        [T.StructField(field.name, T.StringType()) for field in schema]
        + [T.StructField(_BROKEN, T.StringType())]
    )
    parsed = F.from_json(F.col(value), as_text, {"columnNameOfCorruptRecord": _BROKEN})
    return messages.select(*kept, parsed.alias("_message")).select(
        *kept,
        (F.col("_message").isNull() | F.col(f"_message.{_BROKEN}").isNotNull()).alias("is_corrupt"),
        *[_typed(F.col("_message")[field.name], field.dataType).alias(field.name) for field in schema],
    )


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # Timestamps come as ISO text or as milliseconds since 1970.
        from_millis = F.timestamp_millis(text.try_cast("bigint"))
        return F.coalesce(F.try_to_timestamp(text), from_millis).cast(kind)
    return text.try_cast(kind)
