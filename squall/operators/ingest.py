"""Incident ingest: normalise features, count what happened, high-water mark.

``normalise_incidents`` turns API features (one Variant per feature) into rows
of ``raw_incidents`` plus the order columns that decide last-wins (P7, F3,
X16-X18). Counting and the high-water mark are single aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.functions import geo, payload
from squall.functions import timeutil as tu
from squall.schemas import LAT_LON_RAW
from squall.session import ensure_utc

ORDER_COLUMNS = ("landed_at", "doc_day", "page", "pos")

# Fixed value: the source returns at most this many records per request.
SOURCE_PAGE_LIMIT = 1000


def normalise_incidents(features: DataFrame, inserted_at=None, lenient: bool = False,
                        feature_col: str = "feature", faults: bool = False) -> DataFrame:
    """Features -> ``raw_incidents`` rows (+ ``landed_at, doc_day, page, pos`` order columns).

    Features without ``EVENT_UNIQUE_ID`` (NULL or empty) are skipped (Q6).
    ``inserted_at`` defaults to the job's current time. The payload is read
    once into plain columns; later steps work on those. ``faults``: a value that fails the
    job otherwise is named in the column ``fault`` (NULL for a good row) and read as NULL.
    """
    ensure_utc(features.sparkSession)
    lenient = lenient or faults
    f = F.col(feature_col)
    ins = F.current_timestamp() if inserted_at is None else (
        F.lit(inserted_at).cast("timestamp") if isinstance(inserted_at, str) else inserted_at)
    if "landed_at" not in features.columns:     # not from a landing zone: no landing number
        features = features.withColumn("landed_at", F.lit(None).cast("bigint"))
    order = [c for c in ORDER_COLUMNS if c in features.columns]
    fields = features.select(
        *order,
        payload.attribute(f, "EVENT_UNIQUE_ID", "string", lenient=True).alias("event_id"),
        payload.attribute(f, "OBJECTID", "int", lenient=lenient).alias("objectid"),
        f.alias("raw"),
        payload.attribute(f, "OCC_DATE", "bigint", lenient=lenient).alias("__ms"),
        payload.attribute(f, "OCC_HOUR", "int", lenient=True).alias("__hour"),
        payload.attribute(f, "OCC_HOUR", "string", lenient=True).alias("__hour_text"),
        payload.attribute(f, "LAT_WGS84", "decimal(9,6)", lenient=lenient).alias("__lat"),
        payload.attribute(f, "LONG_WGS84", "decimal(9,6)", lenient=lenient).alias("__lon"),
    ).filter(F.coalesce(F.col("event_id"), F.lit("")) != "")
    fields = tu.with_incident_occurrence_utc(fields, "__ms", "__hour", "occ_date_utc",
                                             strict=not lenient, hour_text="__hour_text")
    lat, lon = geo.null_unusable_pair("__lat", "__lon")
    fault = [_row_fault().alias("fault")] if faults else []
    return fields.select(*order, "event_id", "objectid", "raw", "occ_date_utc",
                         lat.cast(LAT_LON_RAW).alias("lat"), lon.cast(LAT_LON_RAW).alias("lon"),
                         ins.alias("inserted_at"), *fault)


def _row_fault() -> Column:
    """The first value of a normalised row that the strict reading raises on; text is read only where a cast gave NULL."""
    dated = F.col("__ms").isNotNull() & (F.col("__ms") != 0)
    cases = [(F.col(c).isNull() & payload.attribute("raw", key, "string", lenient=True).isNotNull(), key)
             for c, key in (("objectid", "OBJECTID"), ("__ms", "OCC_DATE"), ("__lat", "LAT_WGS84"), ("__lon", "LONG_WGS84"))]
    cases.append((dated & F.col("__hour_text").isNotNull() & ~F.coalesce(F.col("__hour").between(0, 23), F.lit(False)), "OCC_HOUR"))
    return F.coalesce(*[F.when(bad, key) for bad, key in cases])


def ingest_counts(features: DataFrame, feature_col: str = "feature") -> DataFrame:
    """Per landing day: features, upserted rows, skipped rows and why.

    One partial+final hash aggregate; nothing is logged per row. A day with
    at least ``SOURCE_PAGE_LIMIT`` records may have been cut by the source.
    """
    ensure_utc(features.sparkSession)
    f = F.col(feature_col)
    eid = payload.attribute(f, "EVENT_UNIQUE_ID", "string", lenient=True)
    has_id = F.coalesce(eid, F.lit("")) != ""
    ms = payload.attribute(f, "OCC_DATE", "bigint", lenient=True)
    lat = payload.attribute(f, "LAT_WGS84", "decimal(9,6)", lenient=True)
    lon = payload.attribute(f, "LONG_WGS84", "decimal(9,6)", lenient=True)
    return (features
            .groupBy("doc_day")
            .agg(F.count(F.lit(1)).alias("n_features"),
                 F.count_if(has_id).alias("n_upserted"),
                 F.count_if(~has_id).alias("n_skipped_no_id"),
                 F.count_if(has_id & ~geo.usable_coordinate(lat, lon)).alias("n_null_coords"),
                 F.count_if(has_id & (ms.isNull() | (ms == 0))).alias("n_no_date"),
                 F.count_distinct(F.when(has_id, eid)).alias("n_distinct_keys"))
            .withColumn("possibly_truncated", F.col("n_features") >= SOURCE_PAGE_LIMIT))


def high_water_mark(raw_incidents: DataFrame, tz: str = tu.LOCAL_TZ) -> DataFrame:
    """``MAX(occ_date_utc)`` and the local day ingest would resume from."""
    ensure_utc(raw_incidents.sparkSession)
    return (raw_incidents
            .agg(F.max("occ_date_utc").alias("max_occ_date_utc"),
                 F.count(F.lit(1)).alias("n_rows"))
            .select("max_occ_date_utc", "n_rows",
                    F.coalesce(tu.next_local_day(F.col("max_occ_date_utc"), tz),
                               F.lit(tu.PROJECT_BASELINE).cast("date")).alias("next_local_day")))
