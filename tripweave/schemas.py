"""Declared schemas of raw files, clean tables, messages and summary tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def _all_text(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


_text, _int, _long, _double, _time = (
    T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType(),
)

# Columns the cleaning jobs need from the raw files. A file may hold more: read it with
# sources.read_declared, which picks these by the header's names.
RAW_WEATHER = _all_text((
    "Station_ID", "Date_Time", "air_temp_set_1", "wind_speed_set_1", "visibility_set_1",
    "weather_summary_set_1d", "weather_condition_set_1d",
))
RAW_STATIONS = _all_text((
    "id", "name", "terminalName", "lat", "long", "nbBikes", "nbEmptyDocks",
))
RAW_TRIPS = _all_text((
    "Duration", "Start date", "End date", "Start station number", "Start station",
    "End station number", "End station", "Bike number", "Member type",
))

STATIONS = _table(
    id=_text, name=_text, terminalName=_text, lat=_double, long=_double,
    nbBikes=_int, nbEmptyDocks=_int,
)

# Fields read from trip messages. Numbers may arrive quoted or bare (see streaming.messages).
TRIP_MESSAGE = _table(
    duration=_double, start_station_id=_text, member_type=_text, lat_start=_double,
    long_start=_double, abs_distance=_double, air_temp=_double, wind_speed=_double,
    visibility=_double, weather_class=_text,
)

# The same with the time by which windows are formed.
TIMED_TRIP_MESSAGE = T.StructType([*TRIP_MESSAGE.fields, T.StructField("start_date", _time)])

# Fields read from model messages: everything is a number.
CITY_MESSAGE = _table(
    hour=_double, dayofyear=_double, month=_double, air_temp=_double, wind_speed=_double,
    visibility=_double, weather_class=_double, label=_double,
)

SCENARIO = _table(
    hour=_int, dayofyear=_int, month=_int, air_temp=_double, wind_speed=_double,
    visibility=_double, weather_class=_text, station=_text,
)
