"""Exact duplicates by distributed MSD radix partitioning on the bytes of the texts.

Round by round, the documents that are still together are dealt out by their next bytes: a group
is one prefix, its key in a round the next chunk of bytes. A document alone in its group is
unique and leaves; the members of a group whose text has ended there are equal and leave
together; the others go on with the following, wider chunk. Equality is decided by the bytes
themselves, no digest takes part.

Scale: a round counts its groups with map-side combining and joins the counts back, so a group of
any size is one row in the count and Spark may split the hot key of the join. Chunks widen by
eight, so even a text of a gigabyte needs about ten rounds. A row is its key (file and index in it):
the first round moves the keys with 64 bytes, and only documents that still share their whole prefix with
another one bring their remaining bytes. Each round's groups and remaining rows are written to the
shared folder, which cuts the lineage.

Defined results: a null text counts as an empty one; empty texts are equal to each other; of
equal texts the row with the largest doc_id stays (null is smallest); of repeated rows with that
same doc_id exactly one stays; an empty table gives an empty table; columns of any name may be
carried along.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import row_keys
from tripweave.llm.row_keys import KEY
from tripweave.sinks.files import store

FIRST_CHUNK_BYTES = 64
CHUNK_GROWTH = 8
WIDEST_CHUNK_BYTES = 1 << 20


def _content(text: str) -> Column:
    return F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")


def find_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``; the last is an output only."""
    return _found(row_keys.from_files(docs), doc_id, text).drop(*KEY)


def _found(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The same for a table read from files, with the keys of the rows."""
    content, width = _content(text), FIRST_CHUNK_BYTES
    keyed = docs.select(
        *row_keys.keys(), F.col(f"`{doc_id}`").alias("doc_id"), F.unhex(F.sha2(content, 256)).alias("_sha"), F.lit(0).cast("long").alias("_group"),
        F.substring(content, 1, width).alias("_chunk"), (F.octet_length(content) <= width).alias("_ended"))
    finished, round_number = [], 0
    while True:
        groups = store(
            keyed.groupBy("_group", "_chunk", "_ended")
            .agg(F.count(F.lit(1)).alias("_size"), F.max("doc_id").alias("_keep"))
            .where(F.col("_size") > 1)
            .withColumn("_next", F.monotonically_increasing_id()),
            f"radix-groups-{round_number}")
        rest = [F.when(F.col("_size").isNotNull() & ~F.col("_ended"), F.col("_rest")).alias("_rest")] if round_number else []
        dealt = store(
            keyed.join(groups.hint("merge"), ["_group", "_chunk", "_ended"], "left").select(
                *KEY, "doc_id", "_sha", "_size", "_keep",
                F.when(F.col("_size").isNotNull(), F.struct(F.lit(round_number).alias("round"), F.col("_next").alias("n"))).alias("_set"),
                F.coalesce(F.col("_size").isNotNull() & ~F.col("_ended"), F.lit(False)).alias("_goes_on"), *rest),
            f"radix-rows-{round_number}")
        finished.append(dealt.where(~F.col("_goes_on")).drop("_rest", "_goes_on"))
        if groups.where(~F.col("_ended")).isEmpty():
            break
        if round_number:
            going_on = dealt.where("_goes_on").withColumn("_group", F.col("_set.n"))
            width = min(width * CHUNK_GROWTH, WIDEST_CHUNK_BYTES)
        else:  # now the texts of these rows, from their start: that names their group too
            width *= 1 + CHUNK_GROWTH
            going_on = row_keys.marked(docs, dealt.where("_goes_on"), [F.col(f"`{doc_id}`"), content], kept=True).select(
                *KEY, F.col("_c0").alias("doc_id"), F.unhex(F.sha2("_c1", 256)).alias("_sha"), F.lit(0).cast("long").alias("_group"),
                F.col("_c1").alias("_rest"))
        round_number += 1
        keyed = going_on.select(  # every byte travels once in a round: in the chunk, or in what is left behind it
            *KEY, "doc_id", "_sha", "_group", F.substring("_rest", 1, width).alias("_chunk"), (F.octet_length("_rest") <= width).alias("_ended"),
            F.expr(f"substring(_rest, {width + 1})").alias("_rest"))
    return _choose(reduce(DataFrame.unionByName, finished))


def _choose(found: DataFrame) -> DataFrame:
    """One row of each group stays: the one with the largest doc_id, the first stored of ties.

    Row numbers are stable, as they number the rows of stored files.
    """
    numbered = found.withColumn("_number", F.monotonically_increasing_id())
    is_best = F.col("_set").isNotNull() & F.col("doc_id").eqNullSafe(F.col("_keep"))
    tied = (
        numbered.where(is_best).groupBy("_set")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_number").alias("_first"))
        .where(F.col("_n") > 1).drop("_n"))

    def columns(keep: Column, kept: Column) -> list:
        return [*KEY, "doc_id", keep.alias("keep_id"), F.coalesce(F.col("_size"), F.lit(1)).cast("long").alias("group_size"),
                kept.alias("kept"), F.lower(F.hex("_sha")).alias("text_sha256")]

    # Unique documents have no group; they stay out of the join, where they would share one key.
    unique = numbered.where(F.col("_set").isNull()).select(*columns(F.col("doc_id"), F.lit(True)))
    grouped = numbered.where(F.col("_set").isNotNull()).join(tied.hint("merge"), "_set", "left")
    first = F.col("_first").isNull() | (F.col("_first") == F.col("_number"))
    return unique.unionByName(grouped.select(*columns(F.col("_keep"), is_best & first)))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their own columns."""
    rows = row_keys.from_files(docs)
    dropped = store(_found(rows, doc_id, text).where(~F.col("kept")).select(*KEY), "exact-copies")
    kept = row_keys.marked(rows, dropped, [F.col(f"`{c}`") for c in docs.columns], kept=False)
    return kept.drop(*KEY).toDF(*docs.columns)
