"""Both as-of plans against brute force: ties, tolerance edges, keys, skew, empty sides."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripweave.operators import asof_join

START = datetime(2019, 1, 1)
LEFT, RIGHT = "k int, place string, at timestamp", "place string, seen timestamp, reading int"


def at(microseconds: int) -> datetime:
    return START + timedelta(microseconds=microseconds)


def brute_force(left, right, tolerance: timedelta, by_place: bool):
    result = []
    for k, place, time in left:
        matches = [
            (seen, reading) for other, seen, reading in right
            if seen is not None and time is not None and (not by_place or (place is not None and other == place))
            and timedelta(0) <= time - seen <= tolerance
        ]
        result.append((k, *(max(matches) if matches else (None, None))))
    return sorted(result, key=repr)


def run(rows, left, right, tolerance_seconds, strategy, by_place=True, **options):
    left_frame, right_frame = rows.of(LEFT, *left), rows.of(RIGHT, *right)
    if not by_place:
        right_frame = right_frame.drop("place")
    joined = asof_join(left_frame, right_frame, "at", "seen", tolerance_seconds,
                       by=["place"] if by_place else [], strategy=strategy, **options)
    return rows.back(joined, "k", "seen", "reading")


@pytest.mark.parametrize("strategy", ["interval", "merge"])
@pytest.mark.parametrize("by_place", [False, True])
def test_random_rows(rows, strategy, by_place):
    draw = random.Random(7)
    span = 5 * 86_400 * 1_000_000
    # A third of the left rows share one instant and a third of the right rows one minute.
    hot = at(draw.randrange(span))
    left = [(k, draw.choice("abc") if k % 17 else None,
             hot if k % 3 == 0 else (None if k % 19 == 0 else at(draw.randrange(span)))) for k in range(300)]
    right = [(draw.choice("abc"), hot - timedelta(seconds=draw.randrange(60)) if r % 3 == 0 else at(draw.randrange(span)), r)
             for r in range(150)] + [("a", None, -1)]
    for tolerance in (30, 3_600, 360_000):
        expected = brute_force(left, right, timedelta(seconds=tolerance), by_place)
        assert run(rows, left, right, tolerance, strategy, by_place) == expected


@pytest.mark.parametrize("strategy", ["interval", "merge"])
def test_edges(rows, strategy):
    second = 1_000_000
    left = [(1, "a", at(0)), (2, "a", at(10 * second)), (3, "a", at(10 * second + 1)), (4, "a", at(-1))]
    right = [("a", at(0), 5)]
    assert run(rows, left, right, 10, strategy) == sorted(
        [(1, at(0), 5), (2, at(0), 5), (3, None, None), (4, None, None)], key=repr)


@pytest.mark.parametrize("strategy", ["interval", "merge"])
def test_empty_sides(rows, strategy):
    assert run(rows, [(1, "a", at(0))], [], 10, strategy) == [(1, None, None)]
    assert run(rows, [], [("a", at(0), 5)], 10, strategy) == []


@pytest.mark.parametrize("strategy", ["interval", "merge"])
def test_readings_at_one_time_go_by_the_tie_break(rows, strategy):
    left = rows.of("k int, at timestamp", (1, at(0)))
    right = rows.of("seen timestamp, reading int, rank int", (at(0), 9, 1), (at(0), 1, 2), (at(0), 3, 2))
    plain = asof_join(left, right, "at", "seen", 10, strategy=strategy)
    ranked = asof_join(left, right, "at", "seen", 10, tie_break=["rank"], strategy=strategy)
    assert rows.back(plain, "reading") == [(9,)]
    assert rows.back(ranked, "reading") == [(3,)]


def test_null_times_and_more_readings_change_neither_rows_nor_plan(rows):
    left = rows.of("k int, at timestamp", (1, at(0)))
    few = rows.of("seen timestamp, reading int", *[(at(-i), i) for i in range(10)])
    many = few.unionByName(rows.of("seen timestamp, reading int", *[(None, i) for i in range(200)], *[(at(i + 1), i) for i in range(200)]))
    plans = []
    for right in (few, many):
        joined = asof_join(left, right, "at", "seen", 10)
        assert rows.back(joined, "reading") == [(0,)]
        plans.append(joined._jdf.queryExecution().optimizedPlan().toString().count("_minute") > 0)
    assert plans == [True, True]


def test_clashing_names_are_refused(rows):
    left, right = rows.of("k int, at timestamp", (1, at(0))), rows.of("at timestamp", (at(0),))
    with pytest.raises(ValueError, match="rename"):
        asof_join(left, right, "at", "at", 10)


def test_streaming_left_side(spark, rows, tmp_path):
    left = rows.of("k int, at timestamp", (1, at(0)), (2, at(-1)))
    right = rows.of("seen timestamp, reading int", (at(0), 5))
    left.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(left.schema).parquet(str(tmp_path / "in"))
    joined = asof_join(stream, right, "at", "seen", 10, strategy="interval").select("k", F.col("reading"))
    query = (joined.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows.back(spark.read.parquet(str(tmp_path / "out"))) == sorted([(1, 5), (2, None)], key=repr)
