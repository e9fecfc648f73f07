"""Profiles of trips, weather and joined data, each a few lazy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import DEFAULT_END_DATE, DEFAULT_START_DATE, WEATHER_TOLERANCE_SECONDS
from tripweave.operators.aggregates import (
    SPREAD, class_shares, counts_by, numeric_profile, spread_of, unpivot_measures,
)
from tripweave.operators.filters import between_dates, implied_by_reading, with_both_ends_in
from tripweave.sinks.files import store

USAGE_KEYS = ("member_type", "bike_number", "start_station_id", "end_station_id")


def trip_profile(enriched: DataFrame) -> dict[str, DataFrame]:
    """Usage by member type, bike and station of either end, most used first, and the spread
    of duration and distance.

    One aggregate with a grouping set for each table reads the trips once, when this is called; its
    rows (one per category) are written to the shared folder. Distances are numbers, so their extremes
    are numeric too.
    """
    columns = ["duration", "abs_distance"]
    sets = enriched.groupingSets([*[[key] for key in USAGE_KEYS], []], *USAGE_KEYS).agg(
        F.grouping_id().alias("_set"), F.count("*").alias("count"), *spread_of(columns))
    found = store(sets, "trip-profile")
    all_set = (1 << len(USAGE_KEYS)) - 1
    per_key = [
        found.where(F.col("_set") == all_set - (1 << i)).select(F.lit(key).alias("attribute"), F.col(key).alias("category"), "count")
        for i, key in enumerate(reversed(USAGE_KEYS))]
    whole = found.where(F.col("_set") == all_set).agg(
        *[F.max(name).alias(name) for name in found.columns if "__" in name])  # one row, also where there are no trips
    return {
        "usage": reduce(DataFrame.unionByName, per_key).orderBy("attribute", F.desc("count"), "category"),
        "numeric": unpivot_measures(whole, columns, list(SPREAD)),
    }


def weather_profile(weather: DataFrame) -> dict[str, DataFrame]:
    """Counts and shares of the classes, and the spread of the readings."""
    return {
        "classes": class_shares(weather, "weather_class"),
        "numeric": numeric_profile(weather, ["air_temp", "wind_speed", "visibility"]),
    }


def joined_class_counts(
    joined: DataFrame, allowed_stations: DataFrame,
    start: str = DEFAULT_START_DATE, end: str = DEFAULT_END_DATE,
    tolerance_seconds: int = WEATHER_TOLERANCE_SECONDS, day: str | None = None,
) -> DataFrame:
    """Trips per weather class, by the time of the weather reading and allowed stations.

    Trips without a reading have no such time and drop out. The dates also bound the trips' own time, by
    the tolerance of the join, and their ``day`` where the trips are partitioned by it; rows that do
    not carry the trip's ``time`` are judged by the reading alone.
    """
    if "time" in joined.columns:
        joined = implied_by_reading(joined, "time", start, end, tolerance_seconds, day)
    kept = with_both_ends_in(between_dates(joined, "date_time", start, end), allowed_stations)
    return counts_by(kept, "weather_class")
