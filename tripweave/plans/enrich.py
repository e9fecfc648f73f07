"""Trips with station coordinates, distance and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import WEATHER_TOLERANCE_SECONDS
from tripweave.functions import haversine_metres
from tripweave.operators.asof import asof_join
from tripweave.operators.grid import distinct_pairs, near_pairs
from tripweave.sinks.files import store


def enrich_trips(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Trips with the coordinates of both ends and the distance in metres.

    Trips with an end outside the station table are left out (see ``reconcile_stations``).
    The station table is broadcast only while Spark finds it under its own size threshold.
    """
    joined = trips
    for end in ("start", "end"):
        coordinates = stations.select(
            F.col("terminalName").alias("_station"),
            F.col("lat").alias(f"lat_{end}"), F.col("long").alias(f"long_{end}"),
        )
        joined = joined.join(
            coordinates, F.col(f"{end}_station_id") == F.col("_station"),
        ).drop("_station")
    return joined.withColumn("abs_distance", haversine_metres(
        F.col("long_start"), F.col("lat_start"), F.col("long_end"), F.col("lat_end"),
    ))


def enrich_by_pairs(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """The rows of ``enrich_trips`` by one join on both ends, with a stored table of the pairs that trips connect.

    Two look-ups by one end each move the trips twice. Here only the pairs are looked up (one row each, written
    to the shared folder when this is called), and trips bucketed by both ends (see ``write_bucketed``) stay in place,
    whether the pairs are broadcast or not.
    """
    ends = ["start_station_id", "end_station_id"]
    pairs = store(enrich_trips(trips.select(*ends).distinct(), stations), "station-pairs")
    joined = trips.join(pairs, ends)
    return joined.select(*trips.columns, *[name for name in pairs.columns if name not in ends])


def add_weather(
    trips: DataFrame,
    weather: DataFrame,
    tolerance_seconds: int = WEATHER_TOLERANCE_SECONDS,
    strategy: str = "merge",
) -> DataFrame:
    """Each trip with the latest weather reading at or before its start, and its ``time``."""
    return asof_join(
        trips.withColumn("time", F.col("start_date")), weather,
        "time", "date_time", tolerance_seconds, strategy=strategy,
    )


def joined_trips(
    trips: DataFrame, stations: DataFrame, weather: DataFrame, strategy: str = "merge",
) -> DataFrame:
    """The extended joined table: coordinates, distance and weather per trip.

    Weather comes first, as the as-of join reads its left side for the times and again for the rows, and
    neither reading should repeat the look-ups of the stations.
    """
    found = enrich_trips(add_weather(trips, weather, strategy=strategy), stations)
    places = ["lat_start", "long_start", "lat_end", "long_end", "abs_distance"]
    return found.select(*trips.columns, *places, "time", *weather.columns)


def station_neighbours(stations: DataFrame, radius_metres: float) -> DataFrame:
    """Ordered pairs of different stations at most so far apart, with their distance.

    A station meets only those of its own and the eight adjoining cells of a grid as wide as the radius.
    """
    pairs = near_pairs(stations.select("id", "lat", "long"), "id", radius_metres)
    distance = haversine_metres(F.col("long_A"), F.col("lat_A"), F.col("long_B"), F.col("lat_B"))
    return pairs.withColumn("abs_distance", distance).where(F.col("abs_distance") <= radius_metres)


def trip_pair_distances(trips: DataFrame, stations: DataFrame) -> DataFrame:
    """Trips and distance of every pair of stations that trips connect; pairs collapse on the map side."""
    pairs = trips.groupBy("start_station_id", "end_station_id").agg(F.count("*").alias("count"))
    return enrich_trips(pairs, stations)


def station_pair_distances(stations: DataFrame, blocks: int | None = None) -> DataFrame:
    """Distance of every ordered pair of different stations; the pair list is the result."""
    pairs = distinct_pairs(stations.select("id", "lat", "long"), "id", blocks=blocks)
    return pairs.withColumn("abs_distance", haversine_metres(
        F.col("long_A"), F.col("lat_A"), F.col("long_B"), F.col("lat_B"),
    ))
