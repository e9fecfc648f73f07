"""What the physical plans of the queries must and must not hold."""

from __future__ import annotations

from datetime import datetime

import pytest

import __spark_entry__ as entry_module
from tripweave import operators as op

DATA = "/root/testdata/sf0.001"


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


BATCH = sorted(n for n in entry_module.oracle_sql() if not n.startswith(("ml_", "stream_", "scan_", "parquet_")))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_products_and_no_python_in_plans(spark, name):
    plan = plan_of(entry_module.queries()[name](spark, DATA))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan, f"{bad} in {name}"


def test_date_and_box_filters_reach_the_scan(spark, rows, tmp_path):
    rows.of("at timestamp, lat double, long double, other string", (datetime(2019, 5, 1), 38.5, -77.0, "x")) \
        .write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = plan_of(op.inside_box(op.between_dates(table, "at")).select("lat"))
    pushed = plan.split("PushedFilters:")[1]
    assert "GreaterThan(at," in pushed and "LessThan(lat," in pushed
    assert "other" not in plan.split("ReadSchema:")[1]


def test_date_filter_on_zoneless_time_is_pushed_too(spark, tmp_path):
    spark.sql("select timestamp_ntz '2019-05-01 00:00:00' as at").write.parquet(str(tmp_path / "t"))
    plan = plan_of(op.between_dates(spark.read.parquet(str(tmp_path / "t")), "at"))
    assert "GreaterThan(at," in plan.split("PushedFilters:")[1]


def test_large_dimension_is_not_broadcast(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("enrich_trips", "semi_join_both_ends", "densify_panel"):
            plan = plan_of(entry_module.queries()[name](spark, DATA))
            assert "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_top_counts_and_previews_do_not_sort_everything(spark):
    for name in ("top_n_stations_desc", "preview_limit"):
        assert "TakeOrderedAndProject" in plan_of(entry_module.queries()[name](spark, DATA))


def test_no_task_orders_all_readings(spark):
    for name in ("asof_join", "asof_join_short_tolerance"):
        plan = plan_of(entry_module.queries()[name](spark, DATA))
        assert "Window" in plan and "SinglePartition" not in plan


def test_asof_reads_its_left_side_twice_and_looks_nothing_up_for_the_times(spark):
    from checks import views

    frame = views.joined(spark, DATA)
    frame.collect()
    final = plan_of(frame).split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "Scan parquet" in line]
    assert "ReusedExchange" in final
    assert sum("nation" in line for line in scans) <= 2  # each end of a trip, once at most
    assert sum("events" in line for line in scans) <= 5  # each side: its times and its rows; the weather is made from events too


def test_filter_on_readings_prunes_days_of_the_trip_table(spark):
    frame = entry_module.queries()["joined_class_counts_by_day"](spark, DATA)
    filters = [part.split("]")[0] for part in plan_of(frame).split("PartitionFilters: [")[1:] if "start_day" in part.split("]")[0]]
    assert filters and all(">=" in f and "<=" in f for f in filters)


def test_profile_reads_the_trips_once(spark, tmp_path):
    from checks import views
    from tripweave import plans

    path = str(tmp_path / "enriched")
    views.enriched(spark, DATA).write.parquet(path)
    profile = plans.trip_profile(spark.read.parquet(path))
    for table in profile.values():
        assert path not in plan_of(table) and "trip-profile" in plan_of(table)
    empty = plans.trip_profile(spark.read.parquet(path).limit(0))
    assert empty["usage"].count() == 0 and [r["mean"] for r in empty["numeric"].collect()] == [None, None]


def test_neighbours_meet_by_cells(spark):
    plan = plan_of(entry_module.queries()["station_neighbours"](spark, DATA))
    assert "_to_row" in plan and "NestedLoop" not in plan


def test_trips_bucketed_by_both_ends_stay_in_place(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = entry_module.queries()["enrich_trips_bucketed"](spark, DATA)
        plan = plan_of(frame)
        plain = plan_of(entry_module.queries()["enrich_trips"](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 1  # that of the pairs
    assert "Bucketed: true" in plan and "Broadcast" not in plan
    assert plain.count("Exchange hashpartitioning") >= 4
