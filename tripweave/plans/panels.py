"""Hourly traffic panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions import trip_hour_keys, weather_code
from tripweave.operators.aggregates import mode_of_counts
from tripweave.operators.grid import all_combinations
from tripweave.sinks.files import store

_WEATHER_AVERAGES = ("air_temp", "visibility", "wind_speed")
_HOUR_KEYS = ("hour", "dayofyear", "month")


def _partials(
    rows: DataFrame,
    keys: Mapping[str, Column],
    averages: Mapping[str, str],
    time: str,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sums and counts per (key, weather class), from which any coarser panel can be finished.

    Only sums and counts: this stays in hash aggregation on the map side, where it shrinks the
    trips to one row per key and class before anything is shuffled, however crowded a key is.
    """
    parts = [F.sum(column).alias(f"_total_{name}") for name, column in (totals or {}).items()]
    for name, column in averages.items():
        parts += [F.sum(column).alias(f"_sum_{name}"), F.count(column).alias(f"_seen_{name}")]
    return rows.groupBy(
        *[column.alias(name) for name, column in keys.items()],
        F.col("weather_class").alias("_class"),
    ).agg(F.count("*").alias("_rows"), F.count(time).alias("_timed"), *parts)


def _coarser(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same partials per fewer keys."""
    sums = [c for c in partials.columns if c.startswith("_") and c != "_class"]
    return partials.groupBy(*keys, "_class").agg(*[F.sum(c).alias(c) for c in sums])


def _finish(
    partials: DataFrame, keys: Sequence[str], averages: Sequence[str], totals: Sequence[str] = (),
) -> DataFrame:
    """Totals, count, averages and most frequent class per key."""
    def average(name: str) -> Column:
        seen = F.nullif(F.sum(f"_seen_{name}"), F.lit(0))
        return (F.sum(f"_sum_{name}") / seen).alias(name)

    return partials.groupBy(*keys).agg(
        *[F.sum(f"_total_{name}").alias(name) for name in totals],
        F.sum("_timed").alias("count"),
        *[average(name) for name in averages],
        mode_of_counts(F.col("_class"), F.col("_rows")).alias("weather_class"),
    )


def station_hour_panel(
    joined: DataFrame, time: str = "time", with_year: bool = False,
) -> DataFrame:
    """Trips, duration, weather, distance and position per hour and start station."""
    keys = trip_hour_keys(F.col(time), with_year) | {"start_station_id": F.col("start_station_id")}
    averages = {name: name for name in (*_WEATHER_AVERAGES, "abs_distance")}
    averages |= {"lat": "lat_start", "long": "long_start"}
    totals = {"total_duration": "duration"}
    return _finish(_partials(joined, keys, averages, time, totals), list(keys), list(averages), list(totals))


def _hours_with_count(joined: DataFrame, time: str, with_year: bool) -> DataFrame:
    keys = trip_hour_keys(F.col(time), with_year)
    averages = {name: name for name in _WEATHER_AVERAGES}
    return _finish(_partials(joined, keys, averages, time), list(keys), _WEATHER_AVERAGES)


def hour_panel(joined: DataFrame, time: str = "time", with_year: bool = False) -> DataFrame:
    """Average weather and most frequent class of each hour."""
    return _hours_with_count(joined, time, with_year).drop("count")


def city_hour_panel(joined: DataFrame, time: str = "time", with_year: bool = False) -> DataFrame:
    """Trips and weather of the whole city per hour; the class becomes its numeric code."""
    return _hours_with_count(joined, time, with_year).withColumn(
        "weather_class", weather_code(F.col("weather_class")),
    )


def dense_station_panel(
    joined: DataFrame, time: str = "time", with_year: bool = False,
) -> DataFrame:
    """Every hour for every station used: trips (zero where none) and weather.

    The joined trips are read once: their partial sums are written to the shared folder, and
    the observed cells, the hours and the stations are all finished from that small table.
    """
    hour_keys = list(trip_hour_keys(F.col(time), with_year))
    observed, hours = observed_cells_and_hours(joined, time, with_year)
    return densify(observed, hours, "station", hour_keys)


def observed_cells_and_hours(
    joined: DataFrame, time: str = "time", with_year: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Observed (hour, station) cells and the weather of each hour, from one stored pass."""
    hour_keys = trip_hour_keys(F.col(time), with_year)
    keys = hour_keys | {"station": F.col("start_station_id")}
    averages = {name: name for name in _WEATHER_AVERAGES}
    partials = store(_partials(joined, keys, averages, time), "panel-partials")
    observed = _finish(partials, list(keys), _WEATHER_AVERAGES)
    hours = _finish(_coarser(partials, list(hour_keys)), list(hour_keys), _WEATHER_AVERAGES)
    return observed, hours.drop("count")


def densify(
    observed: DataFrame, hours: DataFrame, station: str = "station",
    hour_keys: Sequence[str] = _HOUR_KEYS, blocks: int | None = None,
) -> DataFrame:
    """Every hour for every station: observed cells as they are, others with count zero and
    the weather of the hour.

    The join on the keys replaces a union with filler rows followed by a dedupe, which would
    shuffle the dense table instead of only matching it.
    """
    cells = all_combinations(hours, observed.select(station).distinct(), blocks)
    keys = [*hour_keys, station]
    weather = [name for name in hours.columns if name not in hour_keys]
    seen = observed.select(
        *[F.col(name).alias(f"_seen_{name}") for name in (*keys, "count", *weather)],
    )
    same_cell = F.lit(True)
    for name in keys:
        same_cell = same_cell & F.col(name).eqNullSafe(F.col(f"_seen_{name}"))
    was_seen = F.col("_seen_count").isNotNull()
    return cells.join(seen, same_cell, "left").select(
        *keys,
        F.coalesce("_seen_count", F.lit(0).cast("bigint")).alias("count"),
        *[
            F.when(was_seen, F.col(f"_seen_{name}")).otherwise(F.col(name)).alias(name)
            for name in weather
        ],
    )
