"""Great-circle distance and coordinate cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripledger.functions.rounding import from_micro, micro

EARTH_RADIUS_KM = 6371.0  # fixed value


def great_circle_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Haversine distance rounded to a millimetre; NULL unless all coordinates are numbers.

    The chord is clamped to 1 so that rounding noise at opposite points cannot leave the domain
    of the arc sine. ``least`` passes over NULL and NaN, so those are kept out before it.
    """
    def half_angle_squared(a: Column, b: Column) -> Column:
        s = F.sin(F.radians(b - a) / 2)
        return s * s

    chord = (half_angle_squared(lat_a, lat_b)
             + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * half_angle_squared(lon_a, lon_b))
    known = F.abs(lat_a + lon_a + lat_b + lon_b) < F.lit(float("inf"))
    arc = F.asin(F.least(F.lit(1.0), F.sqrt(chord)))
    return F.when(known, from_micro(micro(2 * EARTH_RADIUS_KM * arc)))


def cell(lat: Column, lon: Column) -> Column:
    """Text key of the 0.01-degree cell; NULL when a coordinate is missing."""
    return F.concat(F.round(lat, 2).cast("string"), F.lit(","), F.round(lon, 2).cast("string"))


def route(pickup_area: Column, dropoff_area: Column) -> Column:
    return F.concat(pickup_area, F.lit(" -> "), dropoff_area)
