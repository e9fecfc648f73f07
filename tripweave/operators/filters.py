"""Row filters. All are plain predicates or semi joins, so Catalyst can push them down."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tripweave.fixed_values import (
    DATE_BOUND_FORMAT, DEFAULT_END_DATE, DEFAULT_MAX_LAT, DEFAULT_MAX_LONG,
    DEFAULT_MIN_DISTANCE, DEFAULT_MIN_LAT, DEFAULT_MIN_LONG, DEFAULT_START_DATE,
)


def between_dates(
    rows: DataFrame,
    time: str,
    start: str = DEFAULT_START_DATE,
    end: str = DEFAULT_END_DATE,
    inclusive: bool = False,
) -> DataFrame:
    """Rows whose time lies between two dates (month/day/year); the ends are left out
    unless ``inclusive``. The bounds fold to literals of the column's own type, so the
    filter reaches a Parquet scan.
    """
    low, high = _bounds(rows, time, start, end)
    column = F.col(time)
    if inclusive:
        return rows.where(column.between(low, high))
    return rows.where((column > low) & (column < high))


def _bounds(rows: DataFrame, time: str, start: str, end: str) -> tuple[Column, Column]:
    low, high = (F.to_timestamp(F.lit(bound), DATE_BOUND_FORMAT) for bound in (start, end))
    if isinstance(rows.schema[time].dataType, TimestampNTZType):
        low, high = low.cast("timestamp_ntz"), high.cast("timestamp_ntz")
    return low, high


def implied_by_reading(
    rows: DataFrame, time: str, start: str, end: str, tolerance_seconds: int, day: str | None = None,
) -> DataFrame:
    """Rows whose own time allows a reading between the dates: a reading is at most the tolerance
    older than the row. Drops no row that a filter on the reading's time keeps, but is about the row's own
    columns, so it reaches the scan; with ``day`` (a date column by which a table is partitioned,
    see ``write_by_day``) it names the folders to read.
    """
    low, high = _bounds(rows, time, start, end)
    high = high + F.make_dt_interval(secs=F.lit(tolerance_seconds))
    kept = rows.where((F.col(time) > low) & (F.col(time) < high))
    if day is not None:
        kept = kept.where((F.col(day) >= F.to_date(low)) & (F.col(day) <= F.to_date(high)))
    return kept


def inside_box(
    stations: DataFrame,
    min_lat: float | str = DEFAULT_MIN_LAT,
    min_long: float | str = DEFAULT_MIN_LONG,
    max_lat: float | str = DEFAULT_MAX_LAT,
    max_long: float | str = DEFAULT_MAX_LONG,
    lat: str = "lat",
    long: str = "long",
) -> DataFrame:
    """Stations strictly inside a box; no bound belongs to it."""
    return stations.where(
        (F.col(lat) > float(min_lat)) & (F.col(lat) < float(max_lat))
        & (F.col(long) > float(min_long)) & (F.col(long) < float(max_long))
    )


def message_box(
    min_lat: float = DEFAULT_MIN_LAT,
    min_long: float = DEFAULT_MIN_LONG,
    max_lat: float = DEFAULT_MAX_LAT,
    max_long: float = DEFAULT_MAX_LONG,
    min_distance: float = DEFAULT_MIN_DISTANCE,
) -> Column:
    """Predicate on trip messages: the start lies in the box and the trip is long enough.

    Unlike ``inside_box``, the lower latitude belongs to the box.
    """
    return (
        (F.col("lat_start") >= min_lat) & (F.col("lat_start") < max_lat)
        & (F.col("long_start") > min_long) & (F.col("long_start") < max_long)
        & (F.col("abs_distance") > min_distance)
    )


def with_both_ends_in(
    trips: DataFrame,
    allowed: DataFrame,
    allowed_id: str = "terminalName",
    start_id: str = "start_station_id",
    end_id: str = "end_station_id",
) -> DataFrame:
    """Trips that start and end at an allowed station, as two semi joins.

    No broadcast is forced: Spark broadcasts the ids only if their size is under its own
    threshold, and otherwise joins by shuffle with skewed partitions split at run time.
    """
    for end in (end_id, start_id):
        ids = allowed.select(F.col(allowed_id).alias("_allowed_id"))
        trips = trips.join(ids, F.col(end) == F.col("_allowed_id"), "left_semi")
    return trips


def in_list(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose column is one of a few constants. For ids held as data use a semi join."""
    return rows.where(F.col(column).isin(*values))


def matching(rows: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains a match of the pattern (case-sensitive)."""
    return rows.where(F.col(column).rlike(pattern))
