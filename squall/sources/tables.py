"""Stored tables with their declared schemas.

Layout at scale:

- ``raw_incidents``: Parquet partitioned by occurrence month; an upsert
  rewrites only the months its rows go to or its keys are found in (located
  by a narrow scan of the key and partition columns); the landing number and source order
  columns are kept, so versions compete by them.
- ``weather_cache``: Parquet partitioned by ``date_utc``; an upsert rewrites
  only the days it touches, and day filters prune directories.
- ``run_log``: append-only records (see ``operators.runlog``).
- models: full-refresh Parquet tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.functions import timeutil as tu
from squall.operators import runlog
from squall.schemas import RAW_INCIDENTS, WEATHER_CACHE
from squall.session import ensure_utc
from squall.streaming.ingest import STREAM_TABLE

RAW_PARTITIONING = ["occ_month"]
WEATHER_PARTITIONING = ["date_utc"]


def read_raw_incidents(spark: SparkSession, path: str, start_day: str | None = None,
                       end_day: str | None = None) -> DataFrame:
    """``raw_incidents`` as declared (order and partition columns hidden).

    With local days ``[start_day, end_day)`` (F1) only the months that the range touches are
    read: the month bounds are partition filters, the range itself is pushed to the scan.
    """
    ensure_utc(spark)
    rows = spark.read.schema(STREAM_TABLE).parquet(path)
    lo, hi = (None if d is None else F.to_utc_timestamp(F.lit(d).cast("timestamp"), tu.LOCAL_TZ) for d in (start_day, end_day))
    if lo is not None:
        rows = rows.where((F.col("occ_month") >= F.date_format(lo, "yyyy-MM")) & (F.col("occ_date_utc") >= lo))
    if hi is not None:
        rows = rows.where((F.col("occ_month") <= F.date_format(hi, "yyyy-MM")) & (F.col("occ_date_utc") < hi))
    return rows.select(*[f.name for f in RAW_INCIDENTS.fields])


def read_weather_cache(spark: SparkSession, path: str) -> DataFrame:
    """``weather_cache`` as declared."""
    ensure_utc(spark)
    return spark.read.schema(WEATHER_CACHE).parquet(path).select(*[f.name for f in WEATHER_CACHE.fields])


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Current state of every run (merged records)."""
    return runlog.run_state(spark.read.schema(runlog.RECORDS).parquet(path))


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """A materialised model."""
    ensure_utc(spark)
    return spark.read.parquet(path)
