"""Set operations on station ids and keep-one-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def used_ids(
    trips: DataFrame, start_id: str = "start_station_id", end_id: str = "end_station_id",
) -> DataFrame:
    """Distinct ``station_id`` of both ends. Both ends come from one scan of the trips."""
    return trips.select(F.explode(F.array(start_id, end_id)).alias("station_id")).distinct()


def start_ids_never_ended(
    trips: DataFrame, start_id: str = "start_station_id", end_id: str = "end_station_id",
) -> DataFrame:
    """Distinct ``station_id`` at which trips start but none ends."""
    # Null counts as an id of its own, as in EXCEPT DISTINCT. The flags combine on the map side.
    ends = trips.select(F.explode(F.array(
        F.struct(F.col(start_id).alias("station_id"), F.lit(False).alias("is_end")),
        F.struct(F.col(end_id).alias("station_id"), F.lit(True).alias("is_end")),
    )).alias("end")).select("end.*")
    return (
        ends.groupBy("station_id").agg(F.max("is_end").alias("ended"))
        .where(~F.col("ended")).select("station_id")
    )


def ids_missing_from(
    ids: DataFrame, dimension: DataFrame, id_name: str = "station_id",
    dimension_id: str = "terminalName",
) -> DataFrame:
    """Distinct ids that the dimension does not hold."""
    return ids.select(id_name).subtract(dimension.select(F.col(dimension_id).alias(id_name)))


def names_of(rows: DataFrame, id_name: str, name: str, ids: Sequence[str]) -> DataFrame:
    """Distinct names under which the given ids occur."""
    return rows.where(F.col(id_name).isin(*ids)).select(id_name, name).distinct()


def keep_largest(
    rows: DataFrame, keys: Sequence[str], measure: str, preference: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one with the largest measure.

    Equal measures go to the larger preference columns, then to the larger remaining columns,
    so the result does not depend on row order. The maximum of a struct combines on the map
    side, so a hot key never gathers its rows in one task.
    """
    first = [measure, *preference]
    order = first + [c for c in rows.columns if c not in keys and c not in first]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    kept = {name: F.col("_best")[name].alias(name) for name in order}
    return best.select(*[kept.get(name, F.col(name)) for name in rows.columns])
