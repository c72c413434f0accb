"""Request plans: which days and which weather ranges a fetcher should ask for.

The reference loops over days and coordinates in one thread and calls two web
APIs. Here the loops become tables (one row per request, with its URL), which
any fetcher can consume in parallel; the fetching itself is outside Spark.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.functions import geo, urls
from squall.functions import timeutil as tu
from squall.operators import gaps
from squall.operators.ingest import SOURCE_PAGE_LIMIT
from squall.session import ensure_utc


def resolve_start(spark: SparkSession, start: str | None = None,
                  raw_incidents: DataFrame | None = None) -> DataFrame:
    """One-row frame with the first local day: explicit, else the local day after
    the stored high-water mark, else the project baseline (X19)."""
    if start is not None:
        return spark.range(1).select(F.lit(start).cast("date").alias("start_day"))
    if raw_incidents is None:
        return spark.range(1).select(F.lit(tu.PROJECT_BASELINE).cast("date").alias("start_day"))
    return raw_incidents.agg(
        F.coalesce(tu.next_local_day(F.max("occ_date_utc")),
                   F.lit(tu.PROJECT_BASELINE).cast("date")).alias("start_day"))


def incident_days(start: DataFrame, end: str | None = None) -> DataFrame:
    """Local days ``start_day .. end`` inclusive, one row each, with the request
    URL (G3, X20, X21, X29). Without ``end`` the plan runs to the end of the
    start's quarter. ``end`` before start fails (F2)."""
    ensure_utc(start.sparkSession)
    if end is not None:
        _dt.date.fromisoformat(end)
        end_col = F.lit(end).cast("date")
    else:
        end_col = tu.quarter_end(F.col("start_day"))
    checked = start.withColumn("end_day", end_col).withColumn(
        "end_day", F.when(F.col("end_day") >= F.col("start_day"), F.col("end_day"))
                    .otherwise(F.raise_error(F.lit("End date cannot be before start date."))
                               .cast("date")))
    days = checked.select(F.explode(F.sequence("start_day", "end_day")).alias("local_day"))
    return days.select("local_day",
                       urls.incident_where("local_day").alias("where_clause"),
                       urls.incident_url("local_day").alias("url"))


def incident_days_with_landed(plan: DataFrame, features: DataFrame) -> DataFrame:
    """Plan + how many features already landed per day (A5), one row for each page to ask for.

    A day whose landed features fill a page may have been cut by the source there: the
    next page is planned too, with its offset in the URL.
    """
    landed = features.groupBy(F.col("doc_day").alias("local_day")).agg(
        F.count(F.lit(1)).alias("n_landed"))
    n = F.coalesce("n_landed", F.lit(0))
    full = F.call_function("div", n, F.lit(SOURCE_PAGE_LIMIT))
    pages = plan.join(landed, "local_day", "left").select(
        "local_day", "where_clause", n.alias("n_landed"), (n >= SOURCE_PAGE_LIMIT).alias("possibly_truncated"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), full)).alias("page"))
    return pages.select("local_day", "where_clause", urls.incident_url("local_day", F.col("page") * SOURCE_PAGE_LIMIT).alias("url"),
                        "n_landed", "possibly_truncated", "page")


def weather_requests(ranges: DataFrame) -> DataFrame:
    """One request per missing range, with its URL."""
    return ranges.withColumn("url", urls.weather_url("lat_r", "lon_r", "start_date", "end_date"))


def weather_plan(raw_incidents: DataFrame, weather_cache: DataFrame, exact: bool = False) -> DataFrame:
    """Bulk mode: requests for every gap in the cache."""
    return weather_requests(gaps.missing_ranges(raw_incidents, weather_cache, exact))


def weather_force_requests(points: DataFrame) -> DataFrame:
    """Force mode: one request for each distinct (lat, lon, day), rounded to the grid."""
    return weather_requests(points.select(
        geo.grid_round("lat").alias("lat_r"), geo.grid_round("lon").alias("lon_r"),
        F.col("day").cast("date").alias("start_date"), F.col("day").cast("date").alias("end_date")).distinct())


def weather_force(spark: SparkSession, lat: float, lon: float, day: str) -> DataFrame:
    """Force mode for one grid point and day."""
    return weather_force_requests(spark.range(1).select(
        F.lit(str(lat)).alias("lat"), F.lit(str(lon)).alias("lon"), F.lit(day).alias("day")))
