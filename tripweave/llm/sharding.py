"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

The rows of each input partition are counted; the driver draws, from the multivariate
hypergeometric law, how many rows every partition sends to every shard, so row sums are the
partitions' counts and column sums the shards' sizes (at most one apart). Each partition then
deals its own rows out by a random arrangement of exactly those labels, the rows move to their
shards, and inside a shard they are put in a second random order, which numbers the slots.

Scale: the matrix has one row per input partition and one column per shard, whatever the number
of documents. The second order is drawn in blocks of about ``block_rows`` rows: a random key
names a row's block, blocks are counted, and their sums give each block's first slot. So neither
a shard nor a partition is sorted in one task, and equal texts or a hot source make no difference,
as nothing is dealt by content.

Defined results: null doc_id and null text are ordinary rows (a null text has size 1); repeated
rows get slots of their own; an empty table gives an empty table; other columns pass through.
The seed fixes the draw for one and the same layout of partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripweave.session import ensure_checkpoint_dir


def communication_matrix(rows_of: dict[int, int], n_shards: int, seed: int) -> dict[int, np.ndarray]:
    """Rows that each partition sends to each shard: exact sums on both sides, drawn uniformly."""
    total = sum(rows_of.values())
    left = np.full(n_shards, total // n_shards, np.int64)
    left[: total % n_shards] += 1
    random, matrix = np.random.default_rng(seed), {}
    for partition in sorted(rows_of):
        sent = _draw(random, left, rows_of[partition])
        matrix[partition] = sent
        left = left - sent
    return matrix


def _draw(random: np.random.Generator, left: np.ndarray, count: int) -> np.ndarray:
    """``count`` draws without replacement from urns of ``left`` balls, shard by shard."""
    sent, others = np.zeros(len(left), np.int64), int(left.sum())
    for shard, size in enumerate(left.tolist()):
        others -= size
        if count == 0:
            break
        sent[shard] = _hypergeometric(random, size, others, count)
        count -= int(sent[shard])
    return sent


def _hypergeometric(random: np.random.Generator, good: int, bad: int, count: int) -> int:
    """Good balls among ``count`` drawn from ``good + bad``; numpy's own draw below its limit."""
    if good == 0 or count == 0:
        return 0
    if bad == 0:
        return count
    if good + bad < 1_000_000_000:
        return int(random.hypergeometric(good, bad, count))
    return _by_inversion(random, good, bad, count)


def _by_inversion(random: np.random.Generator, good: int, bad: int, count: int) -> int:
    """Inversion over the law's ratios, twelve deviations around the mean (beyond: below 1e-30)."""
    share = good / (good + bad)
    reach = int(12 * (count * share * (1 - share)) ** 0.5) + 12
    middle = int(count * share)
    low, high = max(0, count - bad, middle - reach), min(good, count, middle + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (count - k)) - np.log((k + 1) * (bad - count + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.exp(logs - logs.max())
    return low + int(np.searchsorted(np.cumsum(weights), random.random() * weights.sum(), side="right"))


def shard_rows(rows: DataFrame, n_shards: int, seed: int = 7, block_rows: int = 65_536) -> DataFrame:
    """The rows with ``shard`` (int) and ``slot`` (long, gapless from 0 inside the shard).

    The rows are checkpointed first: labels belong to places in a partition, and a written
    partition reads the same after an executor is lost. Pass only the columns to be kept.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    names = [f"_c{i}" for i in range(len(rows.columns))]  # any column names may come in
    placed = rows.toDF(*names).checkpoint()
    counts = placed.groupBy(F.spark_partition_id().alias("p")).count().collect()
    rows_of = {r["p"]: r["count"] for r in counts}  # one number per input partition
    matrix = {p: sent.tolist() for p, sent in communication_matrix(rows_of, n_shards, seed).items()}
    total = sum(rows_of.values())
    blocks = max(1, -(-total // (n_shards * block_rows)))
    drawn = T.StructType(placed.schema.fields + [
        T.StructField("shard", T.IntegerType()), T.StructField("_key", T.LongType()), T.StructField("_block", T.IntegerType())])
    sent = spark.sparkContext.broadcast(matrix)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        labels, random, at = None, np.random.default_rng([seed, partition]), 0
        for batch in batches:
            if labels is None:
                labels = np.repeat(np.arange(n_shards, dtype=np.int32), sent.value[partition])
                random.shuffle(labels)  # the local permutation
            n = batch.num_rows
            keys = random.integers(0, 1 << 62, n, dtype=np.int64)
            block = (keys.astype(np.float64) / float(1 << 62) * blocks).astype(np.int32).clip(0, blocks - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels[at:at + n]), pa.array(keys), pa.array(block)],
                names=[*batch.schema.names, "shard", "_key", "_block"])
            at += n

    dealt = placed.mapInArrow(deal, drawn).checkpoint()
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
        .select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
    inside = Window.partitionBy("shard", "_block").orderBy("_key")
    return (
        dealt.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "_block"])
        .withColumn("slot", (F.col("_start") + F.col("_rank")).cast("long"))
        .select(*names, "shard", "slot").toDF(*rows.columns, "shard", "slot"))
