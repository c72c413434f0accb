"""Tables of the pipeline, derived from the driver's parquet tables.

``raw_incidents`` is what ingest would have stored after loading every landed
day (normalise + last-wins upsert into an empty table); ``weather_cache`` is
what the backfill would have stored. Both are lazy DataFrames over ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from squall.operators.ingest import ORDER_COLUMNS, normalise_incidents
from squall.operators.upsert import merge_last_wins
from squall.schemas import DRIVER_TABLES, RAW_INCIDENTS
from squall.session import ensure_utc, plan_settings
from squall.sources import adapters

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read a driver table (only ``columns``), for the registered queries.

    ``squall.deal`` in the session (the benchmark sets it) deals the rows over so many
    partitions: the benchmark's tables are single splits.
    """
    ensure_utc(spark)
    plan_settings(spark)
    schema = DRIVER_TABLES.get(name)
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    df = df.select(*columns) if columns else df
    deal = spark.conf.get("squall.deal", None)
    return df.repartition(int(deal)) if deal else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", EVENT_COLUMNS)


def incident_batch(spark: SparkSession, sf_dir: str, inserted_at: str = adapters.LOAD_TIME) -> DataFrame:
    """Normalised features of every landed day, with their order columns."""
    return normalise_incidents(adapters.incident_features(events(spark, sf_dir)), inserted_at=inserted_at)


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_incidents`` after ingesting all days into an empty table."""
    batch = incident_batch(spark, sf_dir)
    return merge_last_wins(None, batch, ["event_id"], list(ORDER_COLUMNS), ("inserted_at",),
                           [f.name for f in RAW_INCIDENTS.fields])


def weather_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.weather_hours(events(spark, sf_dir))
