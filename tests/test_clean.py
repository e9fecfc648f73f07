"""Cleaning: bad text, nulls, remapped codes, classes, units."""

from __future__ import annotations

import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripweave import operators as op
from tripweave import plans
from tripweave.functions import parse_double, parse_int, parse_time, remap_code, weather_class, weather_code

RAW_TRIP = ", ".join(f"`{name}` string" for name in (
    "Duration", "Start date", "End date", "Start station number", "Start station",
    "End station number", "End station", "Bike number", "Member type"))


def trip(duration="60", start="2019-01-02 03:04:05", end="2019-01-02 03:05:05", start_no="31000",
         end_no="31001", start_name="A"):
    return duration, start, end, start_no, start_name, end_no, "B", "W1", "Member"


def test_trips_drop_what_does_not_parse(rows):
    raw = rows.of(RAW_TRIP, trip(), trip(duration="abc"), trip(start="13/45/2019 01:00"),
                  trip(end=None), trip(start_name=None))
    assert rows.back(plans.clean_trips(raw), "duration", "start_date") == [
        (60, datetime(2019, 1, 2, 3, 4, 5))]


def test_trips_remap_and_drop_codes(rows):
    raw = rows.of(RAW_TRIP, trip(start_no="00000"), trip(end_no="00000"), trip(start_no="31008"),
                  trip(end_no="32031"))
    assert rows.back(plans.clean_trips(raw), "start_station_id", "end_station_id") == [
        ("31000", "31127"), ("31127", "31001")]


def test_time_in_a_clock_change_gap_is_kept(rows):
    raw = rows.of(RAW_TRIP, trip(start="2019-03-31 02:30:00"))
    assert rows.back(plans.clean_trips(raw), "start_date") == [(datetime(2019, 3, 31, 2, 30),)]


def test_numbers_and_times_from_text(rows):
    text = rows.of("t string", ("12",), ("12.7",), ("-3.",), ("",), ("x",), (None,), ("99999999999",))
    assert [r[0] for r in text.select(parse_int(F.col("t"))).collect()] == [12, 12, -3, None, None, None, None]
    assert [r[0] for r in text.select(parse_double(F.col("t"))).collect()] == [
        12.0, 12.7, -3.0, None, None, None, 99999999999.0]
    times = rows.of("t string", ("12/31/2018 23:50 EST",), ("13/45/2019 01:00",), (None,))
    assert [r[0] for r in times.select(parse_time(F.col("t"), "MM/dd/yyyy HH:mm", 16)).collect()] == [
        datetime(2018, 12, 31, 23, 50), None, None]


def test_replaced_code_that_is_removed(rows):
    codes = rows.of("c string", ("a",), ("b",), ("c",), (None,))
    fixed = codes.select(remap_code(F.col("c"), {"a": "b"}, ["b"]).alias("c"))
    assert [r.c for r in fixed.collect()] == [None, None, "c", None]


def test_weather_is_converted_and_incomplete_rows_dropped(rows):
    names = ("Station_ID", "Date_Time", "air_temp_set_1", "wind_speed_set_1", "visibility_set_1",
             "weather_summary_set_1d", "weather_condition_set_1d")
    full = ("S", "12/31/2018 23:50 EST", "50", "3", None, "light rain", "RA")
    gaps = [tuple(None if i == at else v for i, v in enumerate(full)) for at in (0, 1, 2, 3)]
    raw = rows.of(", ".join(f"{n} string" for n in names), full, *gaps,
                  ("S", "bad", "x", "3", "1", None, None))
    assert rows.back(plans.clean_weather(raw)) == sorted([
        (datetime(2018, 12, 31, 23, 50), 10.0, 3.0, "light rain", "RA", None, "light rain"),
        (None, None, 3.0, None, None, 1.0, "clear")], key=repr)


# What the class of a summary has to be: the earliest group found in the text decides.
PRECEDENCE = [
    ({"heavy rain", "heavy drizzle", "heavy_rain"}, "heavy rain"),
    ({"rain", "light drizzle"}, "light rain"),
    ({"broken clouds", "overcast", "cloudy"}, "cloudy"),
    ({"clear", "scattered clouds", "sunny", "obscured"}, "clear"),
    ({"snow"}, "snowy"), ({"ice pellets"}, "icy"), ({"thunder", "squalls"}, "stormy"),
    ({"haze", "mist", "fog"}, "foggy"),
]


def test_weather_class_of_all_phrase_combinations(rows):
    phrases = [(phrase, rank) for rank, (group, _) in enumerate(PRECEDENCE) for phrase in sorted(group)]
    cases = {}
    for size in (1, 2, 3):
        for combination in itertools.permutations(phrases, size):
            best = min(rank for _, rank in combination)
            cases[", ".join(text for text, _ in combination)] = PRECEDENCE[best][1]
    frame = rows.of("summary string, expected string", *cases.items())
    wrong = frame.where(weather_class(F.col("summary")) != F.col("expected"))
    assert wrong.collect() == []


def test_weather_class_of_nothing_and_of_other_text(rows):
    frame = rows.of("s string", (None,), ("windy",), ("RAIN",), ("clear sky",))
    assert [r[0] for r in frame.select(weather_class(F.col("s"))).collect()] == ["clear", "windy", "RAIN", "clear"]
    sunny = frame.select(weather_class(F.col("s"), clear_label="sunny"))
    assert [r[0] for r in sunny.collect()] == ["sunny", "windy", "RAIN", "sunny"]
    codes = frame.select(weather_code(weather_class(F.col("s"))))
    assert [r[0] for r in codes.collect()] == [0.0, 8.0, 8.0, 0.0]


def test_stations_are_typed_and_extended(rows):
    raw = rows.of("id string, name string, terminalName string, lat string, long string, nbBikes string,"
                  " nbEmptyDocks string, other string", ("1", "A", "31000", "38.5", "x", "4", None, "ignored"))
    cleaned = rows.back(plans.clean_stations(raw))
    assert ("1", "A", "31000", 38.5, None, 4, None) in cleaned
    assert len(cleaned) == 2 and any(row[2] == "31086" for row in cleaned)
    assert len(rows.back(plans.clean_stations(raw, extra_rows=()))) == 1


def test_cast_all_and_label(rows):
    frame = rows.of("`a b` string, c int", ("1.5", 2), ("x", None))
    assert rows.back(op.cast_all_double(frame)) == sorted([(1.5, 2.0), (None, None)], key=repr)
    panel = rows.of("hour int, count bigint", (1, 5))
    assert op.label_from_count(panel).dtypes == [("hour", "int"), ("label", "double")]


@pytest.mark.parametrize("inclusive, expected", [(False, [2]), (True, [1, 2, 3])])
def test_date_bounds(rows, inclusive, expected):
    frame = rows.of("k int, at timestamp", (1, datetime(2019, 1, 1)), (2, datetime(2019, 1, 1, 0, 0, 1)),
                    (3, datetime(2019, 1, 3)), (4, datetime(2019, 1, 4)), (5, None))
    kept = op.between_dates(frame, "at", "01/01/2019", "01/03/2019", inclusive)
    assert [r.k for r in kept.orderBy("k").collect()] == expected


def test_box_edges_differ_between_stations_and_messages(rows):
    stations = rows.of("lat double, long double", (38.0, -77.0), (38.1, -77.0), (38.1, -78.0), (40.0, -77.0))
    assert rows.back(op.inside_box(stations, "38", "-78", "40", "-76")) == [(38.1, -77.0)]
    messages = rows.of("lat_start double, long_start double, abs_distance double",
                       (38.0, -77.0, 0.0), (38.1, -78.0, 0.0), (38.1, -77.0, -1.0), (None, -77.0, 0.0))
    assert rows.back(messages.where(op.message_box())) == [(38.0, -77.0, 0.0)]
