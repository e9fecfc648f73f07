"""Distances, joins, counts, sets, grids and panels on small tables."""

from __future__ import annotations

import math
import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripweave import operators as op
from tripweave import plans
from tripweave.functions import haversine_metres

STATION = "id string, name string, terminalName string, lat double, long double"
STATIONS = [("1", "A", "31000", 38.0, -77.0), ("2", "B", "31001", 38.5, -77.5), ("3", "C", "31002", 39.0, -76.5)]


def metres(long_a, lat_a, long_b, lat_b):
    a, b = math.radians(lat_a), math.radians(lat_b)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(long_b - long_a) / 2) ** 2
    return round(2 * 6371 * 1000 * math.asin(math.sqrt(min(1.0, h))))


def test_haversine_on_random_points(rows):
    draw = random.Random(3)
    points = [(draw.uniform(-180, 180), draw.uniform(-90, 90), draw.uniform(-180, 180), draw.uniform(-90, 90))
              for _ in range(2000)]
    points += [(0.0, 0.0, 180.0, 0.0), (10.0, 90.0, -170.0, -90.0), (5.0, 5.0, 5.0, 5.0)]
    frame = rows.of("a double, b double, c double, d double", *points)
    got = frame.select("a", "b", "c", "d", haversine_metres(*map(F.col, "abcd")).alias("m")).collect()
    assert all(abs(r.m - metres(r.a, r.b, r.c, r.d)) <= (0 if r.m < 19_000_000 else 1) for r in got)


def test_enrich_drops_unknown_stations_and_measures(rows):
    trips = rows.of("start_station_id string, end_station_id string",
                    ("31000", "31001"), ("31000", "31000"), ("31000", "9"), ("9", "31001"), (None, "31001"))
    got = rows.back(plans.enrich_trips(trips, rows.of(STATION, *STATIONS)),
                    "start_station_id", "end_station_id", "lat_start", "long_end", "abs_distance")
    assert got == [("31000", "31000", 38.0, -77.0, 0),
                   ("31000", "31001", 38.0, -77.5, metres(-77.0, 38.0, -77.5, 38.5))]


def test_station_pairs_with_any_number_of_blocks(rows):
    stations = rows.of(STATION, *STATIONS, (None, "D", "31003", 38.0, -77.0))
    expected = sorted((a[0], b[0], metres(a[4], a[3], b[4], b[3])) for a in STATIONS for b in STATIONS if a != b)
    for blocks in (1, 4, 30, None):
        pairs = plans.station_pair_distances(stations, blocks)
        assert rows.back(pairs, "id_A", "id_B", "abs_distance") == expected


def test_semi_join_needs_both_ends(rows):
    trips = rows.of("start_station_id string, end_station_id string",
                    ("31000", "31001"), ("31000", "9"), ("9", "31000"), (None, "31000"))
    allowed = rows.of("terminalName string", ("31000",), ("31001",), ("31001",), (None,))
    assert rows.back(op.with_both_ends_in(trips, allowed)) == [("31000", "31001")]


def test_counts_shares_and_top(rows):
    frame = rows.of("k string", *[(k,) for k in "aabbbc"], (None,))
    assert [tuple(r) for r in op.usage_counts(frame, "k").collect()] == [("b", 3), ("a", 2), (None, 1), ("c", 1)]
    assert dict(rows.back(op.class_shares(frame, "k"), "k", "share"))["b"] == 3 / 7
    assert [r.k for r in op.top_counts(frame.dropna(), "k", 2).collect()] == ["b", "a"]
    assert [r.k for r in op.top_counts(frame.dropna(), "k", 2, "asc").collect()] == ["c", "a"]
    with pytest.raises(ValueError):
        op.top_counts(frame, "k", 1, "up")


def test_numeric_profile_is_numeric(rows):
    frame = rows.of("d bigint, e int", (9, 1), (10, None), (100, 3))
    got = {r.attribute: r for r in op.numeric_profile(frame, ["d", "e"]).collect()}
    assert (got["d"]["min"], got["d"]["max"]) == (9.0, 100.0)
    assert got["e"]["mean"] == 2.0 and math.isclose(got["e"]["stddev_samp"], math.sqrt(2))


def test_mode_takes_the_lowest_of_ties_and_ignores_nulls(rows):
    frame = rows.of("k int, v string", (1, "b"), (1, "a"), (2, None), (2, None), (2, "z"), (3, None))
    assert rows.back(op.group_mode(frame, ["k"], "v")) == [(1, "a"), (2, "z"), (3, None)]


def test_station_sets(rows):
    trips = rows.of("start_station_id string, end_station_id string, start_station_name string, end_station_name string",
                    ("1", "2", "A", "B"), ("00000", "1", "X", "A"), (None, "2", "N", "B"))
    stations = rows.of(STATION, ("1", "A", "1", 0.0, 0.0))
    sets = plans.reconcile_stations(trips, stations)
    assert set(rows.back(sets["used"])) == {("1",), ("2",), ("00000",), (None,)}
    assert set(rows.back(sets["missing"])) == {("2",), ("00000",), (None,)}
    assert set(rows.back(sets["start_only"])) == {("00000",), (None,)}
    assert rows.back(sets["known"], "station_id") == [("1",)]
    assert rows.back(sets["undefined_names"]) == [("start", "00000", "X", 1)]


def test_start_only_equals_except(rows):
    draw = random.Random(1)
    ids = [*"abcdefgh", None]
    trips = rows.of("start_station_id string, end_station_id string",
                    *[(draw.choice(ids), draw.choice(ids[:4])) for _ in range(60)])
    expected = trips.select(F.col("start_station_id").alias("station_id")).subtract(
        trips.select(F.col("end_station_id").alias("station_id")))
    assert set(rows.back(op.start_ids_never_ended(trips))) == set(rows.back(expected))


def test_keep_largest_is_deterministic(rows):
    frame = rows.of("k int, n int, observed int, v string",
                    (1, 5, 0, "filler"), (1, 5, 1, "seen"), (1, 4, 1, "less"), (2, 0, 0, None), (2, 0, 0, "x"), (None, 1, 1, "n"))
    assert rows.back(op.keep_largest(frame, ["k"], "n", ["observed"])) == sorted(
        [(1, 5, 1, "seen"), (2, 0, 0, "x"), (None, 1, 1, "n")], key=repr)


def test_all_combinations(rows):
    times = rows.of("h int, w double", *[(h, h / 2) for h in range(7)])
    keys = rows.of("s string", *[(s,) for s in "abcde"])
    for blocks in (1, 3, 50):
        assert rows.back(op.all_combinations(times, keys, blocks)) == sorted(
            ((h, h / 2, s) for h in range(7) for s in "abcde"), key=repr)


def joined_rows(rows, count=400):
    draw = random.Random(11)
    return rows.of(
        "time timestamp, start_station_id string, duration int, air_temp double, visibility double,"
        " wind_speed double, weather_class string, abs_distance bigint, lat_start double, long_start double",
        *[(datetime(2019, 1, 1 + draw.randrange(3), draw.randrange(4), draw.randrange(60)),
           # one station has a third of the trips
           "31000" if k % 3 == 0 else f"3100{draw.randrange(6)}", draw.randrange(1000),
           draw.choice([None, 1.0, 2.0]), float(draw.randrange(5)), 3.0,
           draw.choice(["clear", "foggy", None]), draw.randrange(5000), 38.0, -77.0) for k in range(count)])


def test_station_panel_against_plain_python(rows):
    frame = joined_rows(rows)
    groups = {}
    for r in frame.collect():
        groups.setdefault((r.time.hour, r.time.timetuple().tm_yday, r.time.month, r.start_station_id), []).append(r)
    panel = plans.station_hour_panel(frame).collect()
    assert len(panel) == len(groups)
    for cell in panel:
        members = groups[(cell.hour, cell.dayofyear, cell.month, cell.start_station_id)]
        temps = [m.air_temp for m in members if m.air_temp is not None]
        classes = Counter(m.weather_class for m in members if m.weather_class is not None)
        best = min(classes, key=lambda c: (-classes[c], c)) if classes else None
        assert cell["count"] == len(members) and cell.total_duration == sum(m.duration for m in members)
        assert cell.air_temp == (pytest.approx(sum(temps) / len(temps)) if temps else None)
        assert cell.weather_class == best
        assert cell.abs_distance == pytest.approx(sum(m.abs_distance for m in members) / len(members))


def test_dense_panel_equals_union_and_keep_largest(rows):
    frame = joined_rows(rows, 60)
    observed, hours = plans.observed_cells_and_hours(frame)
    filler = op.all_combinations(hours, observed.select("station").distinct())
    filler = filler.withColumn("count", F.lit(0).cast("bigint")).withColumn("seen", F.lit(0))
    both = observed.withColumn("seen", F.lit(1)).unionByName(filler)
    kept = op.keep_largest(both, ["hour", "dayofyear", "month", "station"], "count", ["seen"]).drop("seen")
    dense = plans.dense_station_panel(frame)
    assert rows.back(dense.select(*sorted(dense.columns))) == rows.back(kept.select(*sorted(kept.columns)))
    assert dense.count() == hours.count() * observed.select("station").distinct().count()
    assert rows.back(hours.select(*sorted(hours.columns))) == rows.back(
        plans.hour_panel(frame).select(*sorted(hours.columns)))


def test_year_key_keeps_years_apart(rows):
    frame = joined_rows(rows, 30)
    shifted = frame.withColumn("time", F.expr("time + interval 2 years"))
    both = frame.unionByName(shifted)
    once = plans.station_hour_panel(frame).count()
    assert plans.station_hour_panel(both).count() == once
    assert plans.station_hour_panel(both, with_year=True).count() == 2 * once
    assert plans.dense_station_panel(both, with_year=True).count() == 2 * plans.dense_station_panel(frame).count()


def test_daily_totals(rows):
    frame = joined_rows(rows, 50)
    got = {r.dayofyear: r for r in op.daily_totals(frame).collect()}
    assert sum(r["count"] for r in got.values()) == 50
    assert {r.dayofyear: r["count"] for r in op.daily_counts(frame).collect()} == {d: r["count"] for d, r in got.items()}


def test_joined_counts_leave_out_trips_without_reading(rows):
    frame = rows.of("date_time timestamp, start_station_id string, end_station_id string, weather_class string",
                    (datetime(2019, 5, 1), "1", "1", "clear"), (None, "1", "1", "clear"), (datetime(2019, 5, 1), "1", "2", "clear"))
    allowed = rows.of("terminalName string", ("1",))
    assert rows.back(plans.joined_class_counts(frame, allowed)) == [("clear", 1)]


def test_near_pairs_hold_all_neighbours(rows):
    import math
    import random

    from tripweave import plans

    draw = random.Random(4)
    def metres(a, b):
        p, q = math.radians(a[1]), math.radians(b[1])
        chord = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[2] - a[2]) / 2) ** 2
        return round(2 * math.asin(min(1, math.sqrt(chord))) * 6_371_000)
    for most in (2, 60, 89.99):  # the last: one cell spans all longitudes
        places = [(f"s{i}", draw.uniform(-most, most), draw.choice([draw.uniform(-180, 180), 179.99, -179.99, draw.uniform(5, 6)])) for i in range(150)]
        places += [("same", *places[0][1:]), ("none", None, 5.0)]
        frame = rows.of("id string, lat double, long double, name string", *((*p, "x") for p in places))
        for radius in (1_000, 300_000, 30_000_000):
            got = {(r["id_A"], r["id_B"]) for r in plans.station_neighbours(frame, radius).collect()}
            sound = places[:-1]
            assert got == {(a[0], b[0]) for a in sound for b in sound if a[0] != b[0] and metres(a, b) <= radius}
    assert plans.station_neighbours(frame.limit(0), 1000).count() == 0


def test_a_crowded_cell_is_met_by_many_tasks(rows):
    from tripweave.operators.grid import near_pairs

    # 700 rows in one place, two ids twice, and a few around it: all pairs but those of one id.
    places = [(f"s{i % 698}", 38.5, -77.0) for i in range(700)] + [(f"t{i}", 38.5 + i / 10, -77.0) for i in range(-9, 10)]
    frame = rows.of("id string, lat double, long double", *places).coalesce(1)
    met = near_pairs(frame, "id", 15_000, block_rows=64, task_pairs=5_000).withColumn("_task", F.spark_partition_id())
    shares = [r["count"] for r in met.groupBy("_task").count().collect()]
    assert len(shares) > 50 and max(shares) < sum(shares) / 10
    near = met.where(F.abs(F.col("lat_A") - F.col("lat_B")) <= 0.11)
    got = sorted((r["id_A"], r["id_B"]) for r in near.select("id_A", "id_B").collect())
    assert got == sorted((a[0], b[0]) for a in places for b in places if a[0] != b[0] and abs(a[1] - b[1]) <= 0.11)
