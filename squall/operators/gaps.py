"""Which (grid point, UTC day) pairs lack weather, and the ranges to request.

Plan shape: incidents are reduced to distinct (lat_r, lon_r, day) first, the
cache to distinct (lat, lon, date_utc) (24x fewer rows than hours, and only
three columns are read); the two meet in one left-anti join. Per-coordinate
ranges are a hash aggregate with map-side partial aggregation, so a hot
coordinate is folded before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from squall.functions import geo
from squall.functions import timeutil as tu
from squall.session import ensure_utc


def coordinate_days(raw_incidents: DataFrame) -> DataFrame:
    """Distinct (lat_r, lon_r, day_utc) of incidents with usable coordinates.

    Incidents without a date are left out: they can never be covered and would
    make a NULL range (Q16).
    """
    ensure_utc(raw_incidents.sparkSession)
    return (raw_incidents
            .filter(geo.usable_coordinate("lat", "lon") & F.col("occ_date_utc").isNotNull())
            .select(geo.grid_round("lat").alias("lat_r"),
                    geo.grid_round("lon").alias("lon_r"),
                    tu.utc_date("occ_date_utc").alias("day_utc"))
            .distinct())


def covered_days(weather_cache: DataFrame) -> DataFrame:
    """Distinct (lat, lon, date_utc) present in the cache."""
    ensure_utc(weather_cache.sparkSession)
    return weather_cache.select("lat", "lon", "date_utc").distinct()


def missing_days(raw_incidents: DataFrame, weather_cache: DataFrame) -> DataFrame:
    """(lat_r, lon_r, day_utc) that have incidents but not a single cached hour."""
    cd = coordinate_days(raw_incidents)
    cov = covered_days(weather_cache)
    return cd.join(cov, (cd["lat_r"] == cov["lat"]) & (cd["lon_r"] == cov["lon"])
                   & (cd["day_utc"] == cov["date_utc"]), "left_anti")


def missing_ranges(raw_incidents: DataFrame, weather_cache: DataFrame,
                   exact: bool = False) -> DataFrame:
    """Per coordinate, the day range(s) to request (A1, A3, O1).

    Default: one ``MIN..MAX`` range per coordinate, as the reference requests
    (covered days inside the range are fetched again, Q15). ``exact=True``
    splits it into runs of consecutive missing days (gaps-and-islands: the day
    minus its rank is constant within a run); the window holds at most one row
    per calendar day of one coordinate.
    """
    md = missing_days(raw_incidents, weather_cache)
    keys = ["lat_r", "lon_r"]
    if exact:
        w = Window.partitionBy(*keys).orderBy("day_utc")
        md = md.withColumn("__run", F.date_sub(F.col("day_utc"), F.row_number().over(w)))
        keys = keys + ["__run"]
    out = (md.groupBy(*keys)
             .agg(F.min("day_utc").alias("start_date"), F.max("day_utc").alias("end_date"),
                  F.count(F.lit(1)).alias("missing_days")))
    return out.drop("__run").orderBy("lat_r", "lon_r", "start_date")
