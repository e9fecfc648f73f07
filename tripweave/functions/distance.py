"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripweave.fixed_values import EARTH_RADIUS_KM


def haversine_metres(long_a: Column, lat_a: Column, long_b: Column, lat_b: Column) -> Column:
    """Haversine distance in whole metres (half to even) as a bigint, all inside codegen."""
    phi_a, phi_b = F.radians(lat_a), F.radians(lat_b)
    sin_lat = F.sin((phi_b - phi_a) / 2)
    sin_long = F.sin((F.radians(long_b) - F.radians(long_a)) / 2)
    chord = sin_lat * sin_lat + F.cos(phi_a) * F.cos(phi_b) * sin_long * sin_long
    # Rounding may push antipodes just above one, where asin is undefined.
    # ``least`` would turn a missing coordinate into half the earth's girth; here it stays null.
    angle = 2 * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))
    return F.abs(F.bround(angle * EARTH_RADIUS_KM * 1000)).cast("bigint")
