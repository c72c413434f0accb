"""Coordinate hygiene: null rule, rounding for the weather grid, validity flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from squall.schemas import LAT_LON_RAW

# Rough bounds of the incident area, inclusive.
LAT_MIN, LAT_MAX = 40, 45
LON_MIN, LON_MAX = -80, -78
GRID_DECIMALS = 2


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_unusable_pair(lat, lon) -> tuple[Column, Column]:
    """(0, 0) or either coordinate missing stores both as NULL."""
    lat, lon = _c(lat), _c(lon)
    bad = lat.isNull() | lon.isNull() | ((lat == 0) & (lon == 0))
    return (F.when(bad, F.lit(None)).otherwise(lat),
            F.when(bad, F.lit(None)).otherwise(lon))


def grid_round(x) -> Column:
    """Round a coordinate to the 2-decimal weather grid, half away from zero.

    Always through ``decimal(9,6)`` so that the writer and the joiner agree
    (the reference rounds floats in one place and numerics in another, Q9).
    """
    return F.round(_c(x).cast(LAT_LON_RAW), GRID_DECIMALS)


def invalid_coordinate(lat, lon) -> Column:
    """True when missing or outside the bounds (true = problem)."""
    lat, lon = _c(lat), _c(lon)
    return (F.when(lat.isNull() | lon.isNull(), True)
             .when((lat < LAT_MIN) | (lat > LAT_MAX), True)
             .when((lon < LON_MIN) | (lon > LON_MAX), True)
             .otherwise(False))


def usable_coordinate(lat, lon) -> Column:
    """Both present and not (0, 0)."""
    lat, lon = _c(lat), _c(lon)
    return lat.isNotNull() & lon.isNotNull() & ~((lat == 0) & (lon == 0))
