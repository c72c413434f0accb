"""Incident and weather source data derived from the driver's ``events`` table.

The reference pulls incidents and weather from two web APIs. Here the same
shapes are derived, row for row, from ``events`` so every query's work grows
with the input: each event becomes one incident feature (the payload the
incident API would return), and every (grid point, day) that events touch
becomes 24 hourly weather rows. The DuckDB oracles in ``__spark_entry__``
compute the same columns from the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions import geo
from squall.functions import timeutil as tu
from squall.schemas import LAT_LON_CACHE, LAT_LON_RAW

# Fixed values of the adapter (shared with the oracle SQL).
LOAD_TIME = "2024-02-01 00:00:00"          # inserted_at of the first load
UPDATE_LOAD_TIME = "2024-03-01 00:00:00"   # inserted_at of the update batch


def _lat_formula() -> Column:
    return (F.lit(43.6).cast("decimal(3,1)")
            + (F.col("user_id") % 5) * F.lit(0.05).cast("decimal(2,2)")
            + (F.col("event_id") % 7) * F.lit(0.0025).cast("decimal(4,4)")).cast(LAT_LON_RAW)


def _lon_formula() -> Column:
    return (F.lit(-79.6).cast("decimal(3,1)")
            + (F.col("user_id") % 5) * F.lit(0.05).cast("decimal(2,2)")
            - (F.col("event_id") % 7) * F.lit(0.0025).cast("decimal(4,4)")).cast(LAT_LON_RAW)


def incident_columns(events: DataFrame) -> DataFrame:
    """One incident per event, as flat typed source columns (FIXTURES C1)."""
    eid = F.col("event_id")
    etype = F.col("event_type")
    local_midnight = F.date_trunc("day", F.col("ts").cast("timestamp"))
    yes_if = lambda cond: F.when(cond, "YES").otherwise("NO")
    return events.select(
        eid.alias("pos"),
        F.to_date("ts").alias("doc_day"),
        (eid % 2147483647).cast("int").alias("objectid"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
         .when(eid % 10 == 1, F.concat(F.lit("GO-"), (eid - 1).cast("string")))
         .otherwise(F.concat(F.lit("GO-"), eid.cast("string"))).alias("event_unique_id"),
        F.when(eid % 89 == 0, F.lit(None).cast("bigint"))
         .otherwise(F.unix_millis(F.to_utc_timestamp(local_midnight, tu.LOCAL_TZ))).alias("occ_ms"),
        F.when(eid % 83 == 0, F.lit(None).cast("string"))
         .otherwise(F.hour("ts").cast("string")).alias("occ_hour"),
        F.date_format("ts", "MMMM").alias("occ_month"),
        F.date_format("ts", "EEEE").alias("occ_dow"),
        F.year("ts").alias("occ_year"),
        F.concat(F.lit("D"), (F.col("user_id") % 6 + 11).cast("string")).alias("division"),
        (F.col("user_id") % 158 + 1).cast("string").alias("hood_158"),
        F.concat(F.lit("Hood "), (F.col("user_id") % 158 + 1).cast("string")).alias("neighbourhood_158"),
        F.when(eid % 59 == 0, F.lit(None).cast(LAT_LON_RAW))
         .when(eid % 53 == 0, F.lit(0).cast(LAT_LON_RAW))
         .otherwise(_lat_formula()).alias("lat0"),
        F.when(eid % 53 == 0, F.lit(0).cast(LAT_LON_RAW))
         .otherwise(_lon_formula()).alias("lon0"),
        F.when((etype == "error") & (F.col("value") > 20), 1)
         .when(eid % 11 == 0, F.lit(None).cast("int"))
         .otherwise(0).alias("fatalities"),
        F.when(etype == "error", "YES").when(etype == "view", "NO")
         .when(etype == "click", "yes").alias("injury"),
        yes_if(eid % 4 == 0).alias("ftr"),
        yes_if(eid % 3 == 0).alias("pd"),
        yes_if(eid % 2 == 0).alias("automobile"),
        yes_if(eid % 17 == 0).alias("motorcycle"),
        F.when(eid % 5 == 0, "YES").when(eid % 5 == 1, "NO").alias("passenger"),
        yes_if(eid % 19 == 0).alias("bicycle"),
        F.when(etype == "purchase", "YES").when(etype == "signup", "Yes")
         .otherwise("NO").alias("pedestrian"),
    )


def incident_pages(events: DataFrame, bad_hour: Column | None = None) -> DataFrame:
    """Incident features grouped into the API's response pages:
    ``(doc_day, page, features ARRAY<STRUCT<pos, feature VARIANT>>)``.

    ``page`` is the 1000-record request page a feature arrives in, so a page
    (one group of the collect) never holds more than the source's page size.
    ``bad_hour`` (a boolean Column over pos, doc_day) gives matching rows an hour that is no number.
    """
    src = incident_columns(events)
    if bad_hour is not None:
        src = src.withColumn("occ_hour", F.when(bad_hour, "xx").otherwise(F.col("occ_hour")))
    attributes = F.struct(
        F.col("objectid").alias("OBJECTID"),
        F.col("event_unique_id").alias("EVENT_UNIQUE_ID"),
        F.col("occ_ms").alias("OCC_DATE"),
        F.col("occ_hour").alias("OCC_HOUR"),
        F.col("occ_month").alias("OCC_MONTH"),
        F.col("occ_dow").alias("OCC_DOW"),
        F.col("occ_year").alias("OCC_YEAR"),
        F.col("division").alias("DIVISION"),
        F.col("fatalities").alias("FATALITIES"),
        F.col("injury").alias("INJURY_COLLISIONS"),
        F.col("ftr").alias("FTR_COLLISIONS"),
        F.col("pd").alias("PD_COLLISIONS"),
        F.col("hood_158").alias("HOOD_158"),
        F.col("neighbourhood_158").alias("NEIGHBOURHOOD_158"),
        F.col("lon0").alias("LONG_WGS84"),
        F.col("lat0").alias("LAT_WGS84"),
        F.col("automobile").alias("AUTOMOBILE"),
        F.col("motorcycle").alias("MOTORCYCLE"),
        F.col("passenger").alias("PASSENGER"),
        F.col("bicycle").alias("BICYCLE"),
        F.col("pedestrian").alias("PEDESTRIAN"),
    )
    geometry = F.struct(F.col("lon0").alias("x"), F.col("lat0").alias("y"))
    feature = F.to_variant_object(F.struct(attributes.alias("attributes"), geometry.alias("geometry")))
    rows = src.select(
        "doc_day",
        F.call_function("div", F.col("pos"), F.lit(1000)).cast("int").alias("page"),
        "pos",
        feature.alias("feature"),
    )
    return rows.groupBy("doc_day", "page").agg(
        F.collect_list(F.struct("pos", "feature")).alias("features"))


def incident_features(events: DataFrame, bad_hour: Column | None = None) -> DataFrame:
    """Features as read out of the pages: ``(doc_day, page, pos, feature VARIANT)``."""
    pages = incident_pages(events, bad_hour)
    return (pages.select("doc_day", "page", F.explode("features").alias("f"))
                 .select("doc_day", "page", "f.pos", "f.feature"))


def weather_hours(events: DataFrame) -> DataFrame:
    """Hourly weather rows for every (grid point, day) the events touch (FIXTURES C2).

    Grid points come from the coordinate formulas of the incidents, days from
    the event dates; each (point, day) expands to its 24 hours by ``explode``
    over a fixed 24-element sequence. Whole days and single hours are left out
    by modular rules so that gaps exist.
    """
    cd = events.select(
        geo.grid_round(_lat_formula()).alias("lat"),
        geo.grid_round(_lon_formula()).alias("lon"),
        F.to_date("ts").alias("day"),
    ).distinct()
    hours = (cd.select("lat", "lon", "day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
             .select("lat", "lon",
                     (F.col("day").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("h")))
                     .alias("hour_utc")))
    lat100 = (F.col("lat") * 100).cast("int")
    k = lat100 + F.dayofmonth("hour_utc")
    m = lat100 + F.dayofmonth("hour_utc") * 24 + F.hour("hour_utc")
    return (hours
            .withColumn("m", m)
            .filter((k % 6 != 0) & (m % 11 != 0))
            .select(
                F.col("lat").cast(LAT_LON_CACHE).alias("lat"),
                F.col("lon").cast(LAT_LON_CACHE).alias("lon"),
                "hour_utc",
                tu.utc_date("hour_utc").alias("date_utc"),
                ((F.col("m") % 400 - 150) / 10).cast("float").alias("temperature"),
                ((F.col("m") % 7) / 10).cast("float").alias("precipitation"),
                ((F.col("m") % 50) / 10000).cast("float").alias("snowfall"),
                F.when(F.col("m") % 13 == 0, F.lit(None).cast("int"))
                 .otherwise((F.col("m") % 100).cast("int")).alias("weathercode"),
                ((F.col("m") % 300) / 10).cast("float").alias("windspeed"),
                (F.col("m") % 101).cast("float").alias("cloudcover"),
                (30 + (F.col("m") % 700) / 10).cast("float").alias("humidity"),
            ))


def run_log_rows(events: DataFrame) -> DataFrame:
    """Pipeline runs derived from events (FIXTURES C4)."""
    eid = F.col("event_id")
    start = F.col("ts").cast("timestamp")
    end = F.when(eid % 29 == 0, F.lit(None).cast("timestamp")) \
           .otherwise(start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (eid % 3600).cast("decimal(18,6)")))
    return events.select(
        F.concat(F.lit("run-"), eid.cast("string")).alias("run_id"),
        F.col("event_type").alias("pipeline_name"),
        start.alias("start_time"),
        end.alias("end_time"),
        F.when(end.isNull(), "running").when(eid % 13 == 0, "failure")
         .otherwise("success").alias("status"),
        F.floor("value").cast("int").alias("row_count"),
        F.when(eid % 7 == 0, "scheduled").otherwise("manual").alias("triggered_by"),
        F.when((eid % 13 == 0) & end.isNotNull(), F.concat(F.lit("error in run "), eid.cast("string")))
         .alias("error_message"),
    )
