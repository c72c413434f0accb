"""Declared schemas of the stored tables and documents (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

LAT_LON_RAW = T.DecimalType(9, 6)      # NUMERIC(9,6) of raw_incidents
LAT_LON_CACHE = T.DecimalType(8, 5)    # NUMERIC(8,5) of weather_cache

# Driver tables read by the registered queries (declared, never inferred).
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType(), True),
    T.StructField("o_custkey", T.LongType(), True),
    T.StructField("o_orderstatus", T.StringType(), True),
    T.StructField("o_totalprice", T.DoubleType(), True),
    T.StructField("o_orderdate", T.TimestampNTZType(), True),
    T.StructField("o_orderpriority", T.StringType(), True),
])

DRIVER_TABLES = {"events": EVENTS, "orders": ORDERS}

RAW_INCIDENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("objectid", T.IntegerType(), True),
    T.StructField("raw", T.VariantType(), True),
    T.StructField("occ_date_utc", T.TimestampType(), True),
    T.StructField("lat", LAT_LON_RAW, True),
    T.StructField("lon", LAT_LON_RAW, True),
    T.StructField("inserted_at", T.TimestampType(), True),
])

WEATHER_CACHE = T.StructType([
    T.StructField("lat", LAT_LON_CACHE, False),
    T.StructField("lon", LAT_LON_CACHE, False),
    T.StructField("hour_utc", T.TimestampType(), False),
    T.StructField("date_utc", T.DateType(), True),
    T.StructField("temperature", T.FloatType(), True),
    T.StructField("precipitation", T.FloatType(), True),
    T.StructField("snowfall", T.FloatType(), True),
    T.StructField("weathercode", T.IntegerType(), True),
    T.StructField("windspeed", T.FloatType(), True),
    T.StructField("cloudcover", T.FloatType(), True),
    T.StructField("humidity", T.FloatType(), True),
])

# Allowed run states.
RUN_STATUSES = ("running", "success", "failure")

# Fixed values. Weather document: parallel hourly arrays, aligned by index.
WEATHER_VARIABLES = {
    # payload key -> (cache column, cache type)
    "temperature_2m": ("temperature", T.FloatType()),
    "precipitation": ("precipitation", T.FloatType()),
    "snowfall": ("snowfall", T.FloatType()),
    "weathercode": ("weathercode", T.IntegerType()),
    "windspeed_10m": ("windspeed", T.FloatType()),
    "cloudcover": ("cloudcover", T.FloatType()),
    "relative_humidity_2m": ("humidity", T.FloatType()),
}

WEATHER_HOURLY = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()), True)]
    + [T.StructField(k, T.ArrayType(T.DoubleType()), True) for k in WEATHER_VARIABLES]
)

WEATHER_DOCUMENT = T.StructType([T.StructField("hourly", WEATHER_HOURLY, True)])

# Landed incident page: ``features`` array of {attributes, geometry} objects.
INCIDENT_DOCUMENT_DDL = "page INT, chunk INT, features ARRAY<VARIANT>"

# Column names and order of the three models (the published data model).
STAGING_COLUMNS = [
    "event_id", "objectid", "event_unique_id", "occ_date_epoch", "occ_date",
    "occ_month", "occ_dow", "occ_year", "occ_hour", "division", "hood_158",
    "neighbourhood_158", "fatalities", "injury_collisions", "ftr_collisions",
    "pd_collisions", "long_wgs84", "lat_wgs84", "automobile", "motorcycle",
    "passenger", "bicycle", "pedestrian", "geometry_x", "geometry_y",
    "occ_date_utc", "lat", "lon", "inserted_at",
]

ENRICH_DERIVED = [
    "lat_r", "lon_r", "invalid_coord_flag", "collision_severity",
    "collision_severity_rank", "occ_date_day", "is_weekend", "season",
]

WEATHER_ATTACHED = [
    "temperature", "precipitation", "snowfall", "weathercode", "windspeed",
    "cloudcover", "humidity", "weather_condition",
]

ENRICHED_COLUMNS = STAGING_COLUMNS + ENRICH_DERIVED + WEATHER_ATTACHED

# Fixed values. Mart: (source column in the enriched model, published name), in order.
MART_COLUMNS = [
    ("event_id", "event_id"),
    ("occ_date_utc", "occ_date_utc"),
    ("occ_date_day", "occ_date_day"),
    ("occ_year", "occ_year"),
    ("occ_month", "occ_month"),
    ("occ_dow", "day_of_week"),
    ("occ_hour", "hour_of_day"),
    ("is_weekend", "is_weekend"),
    ("season", "season"),
    ("daypart", "daypart"),
    ("division", "division"),
    ("hood_158", "tps_hood_code"),
    ("neighbourhood_158", "neighbourhood_158"),
    ("lat", "lat"),
    ("lon", "lon"),
    ("invalid_coord_flag", "invalid_coord_flag"),
    ("collision_severity", "collision_severity"),
    ("collision_severity_rank", "collision_severity_rank"),
    ("fatalities", "fatalities"),
    ("injury_collisions", "injury_collisions"),
    ("ftr_collisions", "ftr_collisions"),
    ("pd_collisions", "pd_collisions"),
    ("automobile", "automobile"),
    ("motorcycle", "motorcycle"),
    ("passenger", "passenger"),
    ("bicycle", "bicycle"),
    ("pedestrian", "pedestrian"),
    ("temperature", "temperature"),
    ("precipitation", "precipitation"),
    ("snowfall", "snowfall"),
    ("weathercode", "weathercode"),
    ("weather_condition", "weather_condition"),
    ("windspeed", "windspeed"),
    ("cloudcover", "cloudcover"),
    ("humidity", "humidity"),
    ("inserted_at", "inserted_at"),
]
