"""The three chained models: staging -> enriched -> flat mart.

Each is a pure DataFrame -> DataFrame function; composed, Catalyst fuses them
into one plan (the staging "view" is just a lazy DataFrame). ``materialise``
writes a model as a full-refresh table (K7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.functions import classify, geo, payload
from squall.functions import timeutil as tu
from squall.operators.weather_join import join_weather
from squall.schemas import MART_COLUMNS, STAGING_COLUMNS
from squall.session import ensure_utc

# Staging column -> payload attribute holding YES/NO text.
YES_NO_FIELDS = {
    "injury_collisions": "INJURY_COLLISIONS",
    "ftr_collisions": "FTR_COLLISIONS",
    "pd_collisions": "PD_COLLISIONS",
    "automobile": "AUTOMOBILE",
    "motorcycle": "MOTORCYCLE",
    "passenger": "PASSENGER",
    "bicycle": "BICYCLE",
    "pedestrian": "PEDESTRIAN",
}


def staging(raw_incidents: DataFrame, lenient: bool = False) -> DataFrame:
    """``raw_incidents`` -> 29 typed columns read out of the payload."""
    ensure_utc(raw_incidents.sparkSession)
    raw = F.col("raw")

    def a(key, type_="string"):
        return payload.attribute(raw, key, type_, lenient)

    epoch = tu.epoch_ms_to_seconds(a("OCC_DATE", "bigint"))
    cols = {
        "event_id": F.col("event_id"),
        "objectid": F.col("objectid"),
        "event_unique_id": a("EVENT_UNIQUE_ID"),
        "occ_date_epoch": epoch,
        "occ_date": tu.epoch_seconds_to_utc_wallclock(epoch),
        "occ_month": a("OCC_MONTH"),
        "occ_dow": a("OCC_DOW"),
        "occ_year": a("OCC_YEAR", "int"),
        "occ_hour": a("OCC_HOUR", "int"),
        "division": a("DIVISION"),
        "hood_158": a("HOOD_158"),
        "neighbourhood_158": a("NEIGHBOURHOOD_158"),
        "fatalities": F.coalesce(a("FATALITIES", "int"), F.lit(0)),
        "long_wgs84": a("LONG_WGS84", "decimal(9,6)"),
        "lat_wgs84": a("LAT_WGS84", "decimal(9,6)"),
        "geometry_x": payload.geometry(raw, "x", "decimal(38,12)", lenient),
        "geometry_y": payload.geometry(raw, "y", "decimal(38,12)", lenient),
        "occ_date_utc": F.col("occ_date_utc"),
        "lat": F.col("lat"),
        "lon": F.col("lon"),
        "inserted_at": F.col("inserted_at"),
    }
    for name, key in YES_NO_FIELDS.items():
        cols[name] = classify.yes_no(a(key))
    return raw_incidents.select(*[cols[c].alias(c) for c in STAGING_COLUMNS])


def prepare(stg: DataFrame) -> DataFrame:
    """Staging + rounded coordinates, validity, severity, calendar fields."""
    ensure_utc(stg.sparkSession)
    sev_args = ("fatalities", "injury_collisions", "ftr_collisions", "pd_collisions")
    return stg.withColumns({
        "lat_r": geo.grid_round("lat"),
        "lon_r": geo.grid_round("lon"),
        "invalid_coord_flag": geo.invalid_coordinate("lat", "lon"),
        "collision_severity": classify.collision_severity(*sev_args),
        "collision_severity_rank": classify.collision_severity_rank(*sev_args),
        # Calendar fields come from occ_date, the UTC wall clock of the raw
        # instant, as the reference's SQL does (Q13).
        "occ_date_day": tu.day_start("occ_date"),
        "is_weekend": tu.is_weekend("occ_date"),
        "season": tu.season("occ_date"),
    })


def enrich(stg: DataFrame, weather_cache: DataFrame, null_salt: int = 1024) -> DataFrame:
    """The 45-column enriched model: ``prepare`` + left join to hourly weather."""
    return join_weather(prepare(stg), weather_cache, null_salt=null_salt)


def mart(enriched: DataFrame) -> DataFrame:
    """The 36-column flat mart: prune, rename, add daypart."""
    cols = []
    for src, name in MART_COLUMNS:
        if name == "daypart":
            cols.append(classify.daypart("occ_hour").alias("daypart"))
        else:
            cols.append(F.col(src).alias(name))
    return enriched.select(*cols)


def build_mart(raw_incidents: DataFrame, weather_cache: DataFrame) -> DataFrame:
    """raw_incidents + weather_cache -> mart, as one lazy plan."""
    return mart(enrich(staging(raw_incidents), weather_cache))


def materialise(df: DataFrame, path: str, partition_by: list[str] | None = None,
                sort_by: list[str] | None = None) -> None:
    """Full-refresh table (``materialized=table``) (K7). ``sort_by`` orders rows
    inside each file so min/max statistics prune range filters on those columns."""
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    # Static: a partition that the new rows do not have goes, whatever the session's mode.
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """``materialized=view``: a lazy temp view (K6)."""
    df.createOrReplaceTempView(name)
    return df


# The model names SQL users query.
VIEW_NAMES = ("stg_tps_incidents", "int_enriched_incidents", "fct_incidents_flat")


def register_views(raw_incidents: DataFrame, weather_cache: DataFrame) -> None:
    """Register the three models as temp views for ``spark.sql`` (one lazy plan each)."""
    stg = as_view(staging(raw_incidents), VIEW_NAMES[0])
    enriched = as_view(enrich(stg, weather_cache), VIEW_NAMES[1])
    as_view(mart(enriched), VIEW_NAMES[2])

