"""Left outer equi-join of incidents to hourly weather.

Incidents match weather on (rounded lat, rounded lon, UTC hour). Rows with a
NULL in any key can never match, but in a plain shuffle join they all hash to
the same few partitions (a NULL adds nothing to the hash). Such rows get a
salted join key instead: a latitude below -999.99999, which no cache row can
hold (``decimal(8,5)``), spread over ``null_salt`` values. They still go
through the same single scan and come out with NULL weather, and the hot NULL
group is split evenly.

The cache side is never broadcast by force: it grows with coordinates x hours,
so the choice is left to AQE, which broadcasts only when the measured size is
under ``spark.sql.autoBroadcastJoinThreshold``.

The UTC day of the hour is joined on as well. It is implied by the hour, so the
result is the same, but it names the cache's partition column: when the
incident side is restricted (a date range, one batch), dynamic partition
pruning skips the cache's other days instead of scanning the whole cache.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions import classify
from squall.session import ensure_utc

WEATHER_VALUES = ["temperature", "precipitation", "snowfall", "weathercode",
                  "windspeed", "cloudcover", "humidity"]

_KEY_TYPE = "decimal(12,5)"


def join_weather(prep: DataFrame, weather: DataFrame, lat: str = "lat_r", lon: str = "lon_r",
                 hour: str = "occ_date_utc", salt_by: str = "event_id",
                 null_salt: int = 1024) -> DataFrame:
    """``prep`` + 7 weather columns + ``weather_condition``; one output row per
    matching cache row (the cache key is unique), all ``prep`` rows kept."""
    ensure_utc(prep.sparkSession)
    any_null = F.col(lat).isNull() | F.col(lon).isNull() | F.col(hour).isNull()
    salt = F.pmod(F.xxhash64(F.col(salt_by)), F.lit(null_salt))
    left = prep.select(
        "*",
        F.when(any_null, (F.lit(-1000) - salt).cast(_KEY_TYPE))
         .otherwise(F.col(lat).cast(_KEY_TYPE)).alias("__jk_lat"),
        F.coalesce(F.col(lon).cast(_KEY_TYPE), F.lit(0).cast(_KEY_TYPE)).alias("__jk_lon"),
        F.coalesce(F.col(hour), F.lit(0).cast("timestamp")).alias("__jk_hour"),
        F.coalesce(F.to_date(F.col(hour)), F.lit("1970-01-01").cast("date")).alias("__jk_day"),
    )
    right = weather.select(
        F.col("lat").cast(_KEY_TYPE).alias("__wk_lat"),
        F.col("lon").cast(_KEY_TYPE).alias("__wk_lon"),
        F.col("hour_utc").alias("__wk_hour"),
        F.col("date_utc").alias("__wk_day"),
        *WEATHER_VALUES,
    )
    joined = left.join(
        right,
        (left["__jk_lat"] == right["__wk_lat"]) & (left["__jk_lon"] == right["__wk_lon"])
        & (left["__jk_hour"] == right["__wk_hour"]) & (left["__jk_day"] == right["__wk_day"]),
        "left")
    return joined.select(
        *prep.columns, *WEATHER_VALUES,
        classify.weather_condition(F.col("weathercode")).alias("weather_condition"))
