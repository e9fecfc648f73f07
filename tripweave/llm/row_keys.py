"""Rows told apart by the file they stand in, and filters on many rows that move no texts.

A table read from files has a key for each row: its file and its index there. Decisions are made on narrow
tables of keys; to apply them, the keys become bitmaps of 32,768 rows each (4 kB), which Spark broadcasts
while they are under its own size threshold and joins by file and bitmap number beyond it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.sinks.files import store

KEY = ("_file", "_index")


def from_files(docs: DataFrame) -> DataFrame:
    """The table itself if it is read from files, else a stored copy that is."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        return store(docs, "rows")


def keys():
    """The columns ``_file`` and ``_index`` of rows read from files."""
    return F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")


def marked(rows: DataFrame, chosen: DataFrame, columns: list, kept: bool) -> DataFrame:
    """``columns`` of those rows (from files) whose key is among ``chosen`` (``kept``) or is not."""
    place = F.col("_index") + 1
    bitmaps = store(  # written first, so that Spark knows their size before it plans the join
        chosen.groupBy("_file", F.bitmap_bucket_number(place).alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_bits")).select(
            F.col("_file").alias("_marked_file"), F.col("_bucket").alias("_marked_bucket"), "_bits"), "marks")
    names = [f"_c{i}" for i in range(len(columns))]  # any column names may come in
    named = rows.select(*[c.alias(n) for c, n in zip(columns, names)], *keys())
    at = F.bitmap_bit_position(F.col("_index") + 1)
    met = named.join(
        bitmaps, (F.col("_file") == F.col("_marked_file")) & (F.bitmap_bucket_number(F.col("_index") + 1) == F.col("_marked_bucket")),
        "inner" if kept else "left")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0, F.lit(False))
    return met.where(is_set if kept else ~is_set).select(*names, *KEY)
