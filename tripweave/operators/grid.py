"""Combinations of two key tables, where the combinations themselves are the result."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import EARTH_RADIUS_KM
from tripweave.sinks.files import store

_BLOCK_ROWS = 2048
_TASK_PAIRS = 4_000_000
_MOST_TASKS = 20_000  # each takes more meetings beyond that


def _blocks(table: DataFrame, blocks: int | None) -> int:
    return blocks or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _block_of(columns: list[str], blocks: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def _every_block(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def all_combinations(times: DataFrame, keys: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every row of ``times`` with every row of ``keys`` (both distinct, small next to the
    result).

    The keys are hashed into blocks and each block meets its own copy of the times through an
    equality join, so the result is spread over the blocks: no single task, broadcast or
    driver list has to hold either side, as a cartesian product would need.
    """
    count = _blocks(times, blocks)
    left = times.withColumn("_block", _every_block(count))
    right = keys.withColumn("_block", _block_of(keys.columns, count))
    return left.join(right, "_block").drop("_block")


def distinct_pairs(
    table: DataFrame, id_name: str, suffixes: tuple[str, str] = ("_A", "_B"),
    blocks: int | None = None,
) -> DataFrame:
    """All ordered pairs of different rows, for tables whose full pair list is wanted.

    Both copies are hashed into a square of blocks, so that each cell joins a small slice of
    one with a small slice of the other.
    """
    side = max(1, int(_blocks(table, blocks) ** 0.5))
    first, second = (
        table.select(*[F.col(name).alias(f"{name}{suffix}") for name in table.columns])
        for suffix in suffixes
    )
    first_id, second_id = (f"{id_name}{suffix}" for suffix in suffixes)
    first = first.withColumn("_row", _block_of([first_id], side)).withColumn("_col", _every_block(side))
    second = second.withColumn("_col", _block_of([second_id], side)).withColumn("_row", _every_block(side))
    pairs = first.join(second, ["_row", "_col"]).where(F.col(first_id) != F.col(second_id))
    return pairs.drop("_row", "_col")


def near_pairs(
    table: DataFrame, id_name: str, radius_metres: float, suffixes: tuple[str, str] = ("_A", "_B"),
    lat: str = "lat", long: str = "long", block_rows: int = _BLOCK_ROWS, task_pairs: int = _TASK_PAIRS,
) -> DataFrame:
    """Ordered pairs of different rows among which are all that lie within a radius of each other.

    Cells are one radius high, and as wide as the radius is at the table's highest latitude, so that the
    nine cells around a row hold all of its neighbours; they close up around the date line.
    Each row is sent to nine cells and meets the rows there by equality. A row without a position has no pair.

    The rows of a cell and those sent to it are hashed into blocks of about ``block_rows``, every two blocks meet
    apart, and there is a task for about ``task_pairs`` meetings: a crowded cell takes more tasks, not longer ones.
    The cells are counted for that when this is called (one row per cell, written to the shared folder).
    """
    # A little more, as distances are rounded.
    angle = (radius_metres + 1) * 1.001 / (EARTH_RADIUS_KM * 1000)
    height = math.degrees(angle)
    placed = table.where(F.col(lat).isNotNull() & F.col(long).isNotNull())
    ratio = F.sin(F.lit(min(angle, math.pi / 2))) / F.cos(F.radians(F.max(F.abs(lat))))
    width = placed.agg(F.when(ratio < 1, F.degrees(F.asin(ratio))).otherwise(360.0)).first()[0]
    around = max(1, math.floor(360.0 / width))
    row = F.floor(F.col(lat) / height)
    col = F.floor(F.pmod(F.col(long) + 180, F.lit(360.0)) * around / 360)
    celled = placed.withColumns({"_row": row, "_col": col})

    def sent(rows: DataFrame) -> DataFrame:
        steps = F.array(F.lit(-1), F.lit(0), F.lit(1))
        cells = F.array_distinct(F.transform(steps, lambda step: F.pmod(F.col("_col") + step, F.lit(around).cast("bigint"))))
        far = rows.withColumn("_to_row", F.explode(F.transform(steps, lambda step: F.col("_row") + step)))
        return far.withColumn("_to_col", F.explode(cells)).drop("_row", "_col")

    counts = celled.groupBy("_row", "_col").agg(F.count(F.lit(1)).alias("_n"))
    own = counts.select(F.col("_row").alias("_to_row"), F.col("_col").alias("_to_col"), F.col("_n").alias("_own"))
    sizes = store(
        sent(counts).groupBy("_to_row", "_to_col").agg(F.sum("_n").alias("_sent")).join(own, ["_to_row", "_to_col"]), "cells")
    meetings = sizes.agg(F.sum(F.col("_own").cast("double") * F.col("_sent"))).first()[0] or 0
    tasks = min(max(1, math.ceil(meetings / task_pairs)), _MOST_TASKS)
    unit = ["_to_row", "_to_col", "_i", "_j"]

    def dealt(rows: DataFrame, suffix: str, mine: str, my_count: str, other: str, other_count: str) -> DataFrame:
        """Each row in its own block of its side, once for every block of the other side."""
        blocks = sizes.select("_to_row", "_to_col", *[
            F.ceil(F.col(name) / block_rows).cast("int").alias(name) for name in (my_count, other_count)])
        named = rows.select("_to_row", "_to_col", *[F.col(name).alias(f"{name}{suffix}") for name in table.columns])
        placed_rows = named.join(blocks, ["_to_row", "_to_col"]).withColumns({
            mine: F.pmod(F.xxhash64(*[f"{name}{suffix}" for name in table.columns]), F.col(my_count)).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))})
        return placed_rows.drop(my_count, other_count).repartition(tasks, *unit)

    one, two = suffixes
    first = dealt(sent(celled), one, "_i", "_sent", "_j", "_own")
    second = dealt(celled.withColumnsRenamed({"_row": "_to_row", "_col": "_to_col"}), two, "_j", "_own", "_i", "_sent")
    near = F.abs(F.col(f"{lat}{one}") - F.col(f"{lat}{two}")) <= height
    pairs = first.join(second.hint("merge"), unit).where((F.col(f"{id_name}{one}") != F.col(f"{id_name}{two}")) & near)
    return pairs.drop(*unit)
