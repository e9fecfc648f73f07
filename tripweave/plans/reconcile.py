"""Which station ids trips use, and which of them the station table does not know."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.fixed_values import STATION_CODES_UNDEFINED
from tripweave.operators.sets import ids_missing_from
from tripweave.sinks.files import store


def used_stations(ids: DataFrame, stations: DataFrame) -> DataFrame:
    """Rows of the station table for the ids in use."""
    return ids.join(stations, ids["station_id"] == stations["terminalName"])


def station_ends(trips: DataFrame) -> DataFrame:
    """Trips per ``station_id``, ``station_name`` and ``end`` (start or end), in one pass."""
    ends = F.array(*[
        F.struct(
            F.col(f"{end}_station_id").alias("station_id"),
            F.col(f"{end}_station_name").alias("station_name"), F.lit(end).alias("end"),
        ) for end in ("start", "end")
    ])
    return trips.select(F.inline(ends)).groupBy("station_id", "station_name", "end").agg(
        F.count("*").alias("count"),
    )


def reconcile_stations(trips: DataFrame, stations: DataFrame) -> dict[str, DataFrame]:
    """Used, known and missing ids, ids at which trips only start, and the names under which
    undefined ids occur.

    The trips are read once: their counted ends are written to the shared folder, and
    everything else starts from that small table.
    """
    ends = store(station_ends(trips), "station-ends")
    ids = ends.select("station_id").distinct()
    starts = ends.where(F.col("end") == "start").select("station_id")
    stops = ends.where(F.col("end") == "end").select("station_id")
    undefined = ends.where(F.col("station_id").isin(*STATION_CODES_UNDEFINED))
    return {
        "used": ids,
        "known": used_stations(ids, stations),
        "missing": ids_missing_from(ids, stations),
        "start_only": starts.subtract(stops),
        "undefined_names": undefined.select("end", "station_id", "station_name", "count"),
    }
