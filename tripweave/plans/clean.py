"""Raw text tables to typed tables, each in one projection."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import (
    CLEAR_CLASS, MISSING_STATION, STATION_CODE_REMAP, STATION_CODES_REMOVED,
    TRIP_TIME_FORMAT, WEATHER_TIME_FORMAT, WEATHER_TIME_LENGTH,
)
from tripweave.functions import (
    celsius, parse_double, parse_int, parse_time, remap_code, weather_class,
)
from tripweave.sources.rows import append_rows


def clean_weather(
    raw: DataFrame, clear_label: str = CLEAR_CLASS, carry: Sequence[str] = (),
) -> DataFrame:
    """Typed weather readings in degrees Celsius with a weather class.

    Rows without station, time, temperature or wind are dropped before parsing; values that
    do not parse stay as nulls. ``carry`` passes further raw columns through.
    """
    present = raw.na.drop(
        subset=["Station_ID", "Date_Time", "air_temp_set_1", "wind_speed_set_1"],
    )
    summary = F.col("weather_summary_set_1d")
    return present.select(
        *carry,
        parse_time(F.col("Date_Time"), WEATHER_TIME_FORMAT, WEATHER_TIME_LENGTH).alias("date_time"),
        celsius(parse_double(F.col("air_temp_set_1"))).alias("air_temp"),
        parse_double(F.col("wind_speed_set_1")).alias("wind_speed"),
        summary.alias("weather_summary"),
        F.col("weather_condition_set_1d").alias("weather_condition"),
        parse_double(F.col("visibility_set_1")).alias("visibility"),
        weather_class(summary, clear_label).alias("weather_class"),
    )


def clean_trips(
    raw: DataFrame,
    replacements: Mapping[str, str] = STATION_CODE_REMAP,
    removed: Collection[str] = STATION_CODES_REMOVED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Typed trips with corrected station codes; rows with a null in a typed column are dropped.

    Carried columns may be null."""
    trips = raw.select(
        *carry,
        parse_int(F.col("Duration")).alias("duration"),
        parse_time(F.col("Start date"), TRIP_TIME_FORMAT).alias("start_date"),
        parse_time(F.col("End date"), TRIP_TIME_FORMAT).alias("end_date"),
        remap_code(F.col("Start station number"), replacements, removed).alias("start_station_id"),
        F.col("Start station").alias("start_station_name"),
        remap_code(F.col("End station number"), replacements, removed).alias("end_station_id"),
        F.col("End station").alias("end_station_name"),
        F.col("Bike number").alias("bike_number"),
        F.col("Member type").alias("member_type"),
    )
    return trips.na.drop("any", subset=[c for c in trips.columns if c not in carry])


def clean_stations(
    raw: DataFrame, extra_rows: Sequence[tuple] = (MISSING_STATION,),
) -> DataFrame:
    """Typed stations, followed by stations known to be missing from the file."""
    stations = raw.select(
        "id", "name", "terminalName",
        parse_double(F.col("lat")).alias("lat"),
        parse_double(F.col("long")).alias("long"),
        parse_int(F.col("nbBikes")).alias("nbBikes"),
        parse_int(F.col("nbEmptyDocks")).alias("nbEmptyDocks"),
    )
    return append_rows(stations, extra_rows) if extra_rows else stations
