"""Calendar keys of a time column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(time: Column) -> dict[str, Column]:
    return {"hour": F.hour(time), "dayofyear": F.dayofyear(time), "month": F.month(time)}


def trip_hour_keys(time: Column, with_year: bool = False) -> dict[str, Column]:
    """Keys of one hour of the year. Several years share keys unless ``with_year`` is set."""
    keys = calendar_parts(time)
    return {"year": F.year(time), **keys} if with_year else keys
