"""Great-circle distance as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    def half_sine_squared(a: Column, b: Column) -> Column:
        return F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))

    chord = half_sine_squared(lat_a, lat_b) + (
        F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_sine_squared(lon_a, lon_b)
    )
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))
