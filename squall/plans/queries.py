"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables (mostly ``events`` through the source
adapters, ``orders`` for calendar coverage) over their whole extent, runs one
or more operators of the library, and projects the result onto portable types
(``to_portable``) so that the DuckDB oracle can compare it value by value.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.functions import classify, geo, payload
from squall.functions import timeutil as tu
from squall.operators import commit, export, filters, gaps, ingest, onefile, quality, runlog, upsert
from squall.plans import datasets, models, requests, runs
from squall.plans.portable import to_portable
from squall.schemas import RAW_INCIDENTS, RUN_STATUSES, WEATHER_CACHE
from squall.session import scratch_path
from squall.sources import adapters, landed, tables
from squall.streaming import ingest as stream_ingest


def fct_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat mart (36 columns), built from raw incidents and the weather cache."""
    raw = datasets.raw_incidents(spark, sf_dir)
    weather = datasets.weather_cache(spark, sf_dir)
    return to_portable(models.build_mart(raw, weather))


def int_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 45-column enriched model (staging + derived + weather)."""
    stg = models.staging(datasets.raw_incidents(spark, sf_dir))
    return to_portable(models.enrich(stg, datasets.weather_cache(spark, sf_dir)))


def stg_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 29-column staging model read out of the Variant payload."""
    return to_portable(models.staging(datasets.raw_incidents(spark, sf_dir)))


def join_weather_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left join of every incident to its hourly weather, NULL keys included."""
    j = models.enrich(models.staging(datasets.raw_incidents(spark, sf_dir)),
                      datasets.weather_cache(spark, sf_dir))
    return to_portable(j.select("event_id", "lat_r", "lon_r", "occ_date_utc", "temperature",
                                "weathercode", "weather_condition",
                                F.col("temperature").isNotNull().alias("matched")))


# --- ingest -----------------------------------------------------------------

def ingest_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feature with an id, normalised (before last-wins)."""
    b = datasets.incident_batch(spark, sf_dir)
    return to_portable(b.drop("raw", "landed_at"))


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per landing day: features, upserts, skips by reason, distinct keys."""
    feats = adapters.incident_features(datasets.events(spark, sf_dir))
    return to_portable(ingest.ingest_counts(feats))


def ingest_high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAX(occ_date_utc) of raw_incidents and the next local day to fetch."""
    return to_portable(ingest.high_water_mark(datasets.raw_incidents(spark, sf_dir)))


def filter_day_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents of a half-open range of local days [2024-01-08, 2024-01-15)."""
    raw = datasets.raw_incidents(spark, sf_dir)
    pred = filters.local_day_range("occ_date_utc", "2024-01-08", "2024-01-15")
    return to_portable(raw.filter(pred).select("event_id", "occ_date_utc", "lat", "lon"))


# --- scalar expressions -------------------------------------------------------

def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``props`` JSON: typed path read, text path read, parse/serialise round trip."""
    ev = datasets.read_table(spark, sf_dir, "events", ["event_id", "props"])
    v = payload.parse(F.col("props"))
    return (ev.withColumn("__v", v)
              .select("event_id",
                      payload.path_get("__v", "$.k", "int").alias("k"),
                      payload.text_get("props", "$.k").alias("k_text"),
                      payload.serialise("__v").alias("props_json")))


def time_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCC_DATE ms -> whole seconds (truncating) -> zone-less UTC wall clock."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    sec = tu.epoch_ms_to_seconds("occ_ms")
    return src.select("pos", "occ_ms", sec.alias("occ_date_epoch"),
                      tu.epoch_seconds_to_utc_wallclock(sec).alias("occ_date"))


def time_local_to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OCC_DATE + OCC_HOUR (local) -> UTC instant with standard-time DST rule."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    src = src.select("pos", "occ_ms", F.col("occ_hour").cast("int").alias("occ_hour"))
    out = tu.with_incident_occurrence_utc(src, "occ_ms", "occ_hour", "occ_date_utc")
    return to_portable(out.withColumn(
        "utc_offset_hours",
        ((F.unix_seconds(F.from_utc_timestamp("occ_date_utc", tu.LOCAL_TZ))
          - F.unix_seconds("occ_date_utc")) / 3600).cast("int")))


def time_dst_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every local hour of every order date -> UTC instant (covers all DST switches)."""
    days = (datasets.read_table(spark, sf_dir, "orders", ["o_orderdate"])
            .select(F.to_date("o_orderdate").alias("local_date")).distinct())
    hours = days.select("local_date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    return to_portable(hours.withColumn(
        "utc", tu.local_date_hour_to_utc("local_date", "hour")))


def coords_null_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(0,0) or a missing coordinate -> both NULL."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    lat, lon = geo.null_unusable_pair("lat0", "lon0")
    return to_portable(src.select("pos", "lat0", "lon0", lat.alias("lat"), lon.alias("lon")))


def coords_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates on the 2-decimal weather grid (half away from zero)."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    return to_portable(src.select("pos", geo.grid_round("lat0").alias("lat_r"),
                                  geo.grid_round("lon0").alias("lon_r")))


def coords_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invalid-coordinate flag after the null rule."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    lat, lon = geo.null_unusable_pair("lat0", "lon0")
    return (src.select("pos", lat.alias("lat"), lon.alias("lon"))
               .select("pos", geo.invalid_coordinate("lat", "lon").alias("invalid_coord_flag")))


def flags_yes_no(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight YES/NO payload flags as nullable booleans."""
    src = adapters.incident_columns(datasets.events(spark, sf_dir))
    names = {"injury_collisions": "injury", "ftr_collisions": "ftr", "pd_collisions": "pd",
             "automobile": "automobile", "motorcycle": "motorcycle", "passenger": "passenger",
             "bicycle": "bicycle", "pedestrian": "pedestrian"}
    return src.select("pos", *[classify.yes_no(s).alias(n) for n, s in names.items()])


def calendar_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day start, weekend flag and season of every order date (all months)."""
    o = datasets.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    return o.select("o_orderkey",
                    tu.day_start("o_orderdate").alias("occ_date_day"),
                    tu.is_weekend("o_orderdate").alias("is_weekend"),
                    tu.season("o_orderdate").alias("season"))


def classify_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity label and rank of every staged incident."""
    stg = models.staging(datasets.raw_incidents(spark, sf_dir))
    args = ("fatalities", "injury_collisions", "ftr_collisions", "pd_collisions")
    return stg.select("event_id", *args,
                      classify.collision_severity(*args).alias("collision_severity"),
                      classify.collision_severity_rank(*args).alias("collision_severity_rank"))


def classify_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather condition bucket of every cached hour."""
    w = datasets.weather_cache(spark, sf_dir)
    return to_portable(w.select("lat", "lon", "hour_utc", "weathercode",
                                classify.weather_condition("weathercode").alias("weather_condition")))


def classify_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daypart of every staged incident's hour."""
    stg = models.staging(datasets.raw_incidents(spark, sf_dir))
    return stg.select("event_id", "occ_hour", classify.daypart("occ_hour").alias("daypart"))


# --- upsert -------------------------------------------------------------------

def upsert_incidents_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows (first load) updated by a second batch: last wins, inserted_at kept."""
    keys, order = ["event_id"], list(ingest.ORDER_COLUMNS)
    cols = [f.name for f in RAW_INCIDENTS.fields]
    first = F.col("pos") % 10 != 1
    first = first & (F.col("pos") % 5 != 3)
    stored = upsert.merge_last_wins(
        None, datasets.incident_batch(spark, sf_dir).filter(first), keys, order,
        ("inserted_at",), cols)
    update = datasets.incident_batch(spark, sf_dir, adapters.UPDATE_LOAD_TIME).filter(~first)
    merged = upsert.merge_last_wins(stored, update, keys, order, ("inserted_at",), cols)
    return to_portable(merged.drop("raw"))


def upsert_weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather cache updated by two later documents on (lat, lon, hour_utc)."""
    w = datasets.weather_cache(spark, sf_dir)
    day = F.dayofmonth("hour_utc")
    m = (F.col("lat") * 100).cast("int") + day * 24 + F.hour("hour_utc")
    stored = w.filter(day % 3 != 0)
    doc0 = (w.filter(day % 3 != 1)
             .withColumn("temperature", (F.col("temperature") + 1).cast("float"))
             .withColumn("doc", F.lit(0)))
    doc1 = (w.filter(m % 5 == 0)
             .withColumn("temperature", (F.col("temperature") + 2).cast("float"))
             .withColumn("doc", F.lit(1)))
    merged = upsert.merge_last_wins(stored, doc0.unionByName(doc1), ["lat", "lon", "hour_utc"],
                                    ["doc"], (), [f.name for f in WEATHER_CACHE.fields])
    return to_portable(merged)


# --- gaps and plans -------------------------------------------------------------

def gap_missing_days_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grid point, UTC day) pairs with incidents but no cached weather."""
    return to_portable(gaps.missing_days(datasets.raw_incidents(spark, sf_dir),
                                         datasets.weather_cache(spark, sf_dir)))


def gap_missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIN..MAX missing day range per grid point, ordered by coordinate."""
    return to_portable(gaps.missing_ranges(datasets.raw_incidents(spark, sf_dir),
                                           datasets.weather_cache(spark, sf_dir)))


def gap_missing_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of consecutive missing days per grid point (exact ranges)."""
    return to_portable(gaps.missing_ranges(datasets.raw_incidents(spark, sf_dir),
                                           datasets.weather_cache(spark, sf_dir), exact=True))


def plan_incident_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily requests from the first landed local day to the end of its quarter,
    with the features already landed per day."""
    feats = adapters.incident_features(datasets.events(spark, sf_dir))
    start = feats.agg(F.min("doc_day").alias("start_day"))
    plan = requests.incident_days(start)
    return requests.incident_days_with_landed(plan, feats)


def plan_weather_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Force-mode weather requests: one per distinct grid point and day of the events."""
    ev = datasets.events(spark, sf_dir)
    points = adapters.incident_columns(ev).select(F.col("lat0").alias("lat"), F.col("lon0").alias("lon"), F.col("doc_day").alias("day"))
    return to_portable(requests.weather_force_requests(points.where("lat is not null and lon is not null and lat <> 0")))


def plan_weather_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk weather requests: one per missing range, with its URL."""
    return to_portable(requests.weather_plan(datasets.raw_incidents(spark, sf_dir),
                                             datasets.weather_cache(spark, sf_dir)))


# --- run log, quality, export ---------------------------------------------------

def _run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start and end records of the runs derived from events (C4)."""
    runs = adapters.run_log_rows(datasets.events(spark, sf_dir))
    start = runs.select("run_id", "pipeline_name", "start_time",
                        F.lit(None).cast("timestamp").alias("end_time"),
                        F.lit(runlog.DEFAULT_STATUS).alias("status"),
                        F.lit(None).cast("int").alias("row_count"), "triggered_by",
                        F.lit(None).cast("string").alias("error_message"),
                        F.col("start_time").alias("recorded_at"), F.lit(0).alias("seq"))
    end = (runs.filter(F.col("end_time").isNotNull())
               .select("run_id", F.lit(None).cast("string").alias("pipeline_name"),
                       F.lit(None).cast("timestamp").alias("start_time"), "end_time", "status",
                       "row_count", F.lit(None).cast("string").alias("triggered_by"),
                       "error_message", F.col("end_time").alias("recorded_at"), F.lit(1).alias("seq")))
    return start.unionByName(end)


def run_log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run states merged from start/end records, summarised per pipeline."""
    return runlog.run_summary(runlog.run_state(_run_records(spark, sf_dir)))


def run_log_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest run of every pipeline."""
    latest = runlog.latest_runs(runlog.run_state(_run_records(spark, sf_dir)))
    return to_portable(latest.drop("duration"))


def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """not_null / unique / accepted-values / non-empty checks over every model."""
    raw = datasets.raw_incidents(spark, sf_dir)
    weather = datasets.weather_cache(spark, sf_dir)
    stg = models.staging(raw)
    enriched = models.enrich(stg, weather)
    mart = models.mart(enriched)
    state = runlog.run_state(_run_records(spark, sf_dir))
    checks = []
    for name, df in (("stg_tps_incidents", stg), ("int_enriched_incidents", enriched),
                     ("fct_incidents_flat", mart)):
        checks.append(quality.key_checks(df, name, ["event_id"]))
    checks += [quality.non_empty(mart, "fct_incidents_flat"),
               quality.has_column(mart, "fct_incidents_flat", "event_id")]
    checks += [quality.key_checks(weather, "weather_cache", ["lat", "lon", "hour_utc"]),
               quality.accepted_values(state, "run_log", "status", RUN_STATUSES)]
    return quality.report(checks)


def export_mart_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as the text of its CSV export, one row per incident."""
    mart = models.build_mart(datasets.raw_incidents(spark, sf_dir), datasets.weather_cache(spark, sf_dir))
    return export.csv_text(mart)


def export_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the mart as CSV under the shared scratch folder and read it back."""
    mart = models.build_mart(datasets.raw_incidents(spark, sf_dir), datasets.weather_cache(spark, sf_dir))
    path = scratch_path(spark, "export")
    export.write_csv(mart, path)
    return to_portable(export.read_csv(spark, path, mart.schema))


def export_one_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the mart as one CSV file ordered by event, with all tasks, and read it back."""
    mart = models.build_mart(datasets.raw_incidents(spark, sf_dir), datasets.weather_cache(spark, sf_dir))
    path = f"{scratch_path(spark, 'export')}/incidents.csv"
    onefile.write_csv_file(mart, path, ["event_id"])
    return to_portable(onefile.read_csv_file(spark, path, mart.schema))


# --- landed documents and streaming (write to the shared scratch folder first) ---

def _landed_incidents(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "landed-incidents")
    landed.land_incident_documents(adapters.incident_features(datasets.events(spark, sf_dir)), path)
    return path


def _feature_columns(features: DataFrame) -> DataFrame:
    f = F.col("feature")
    return to_portable(features.select(
        "doc_day", "page", "pos",
        payload.attribute(f, "EVENT_UNIQUE_ID").alias("event_unique_id"),
        payload.attribute(f, "OBJECTID", "int").alias("objectid"),
        payload.attribute(f, "OCC_DATE", "bigint").alias("occ_ms"),
        payload.attribute(f, "OCC_HOUR").alias("occ_hour"),
        payload.attribute(f, "LAT_WGS84", "decimal(9,6)").alias("lat0"),
        payload.attribute(f, "LONG_WGS84", "decimal(9,6)").alias("lon0")))


def src_incident_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land incident pages by local day, read them back and explode the features."""
    path = _landed_incidents(spark, sf_dir)
    return _feature_columns(landed.read_incident_documents(spark, path))


def src_partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read one week of landed days; the other days' directories are pruned."""
    path = _landed_incidents(spark, sf_dir)
    return _feature_columns(landed.read_incident_documents(spark, path, "2024-01-08", "2024-01-14"))


def src_weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land weather documents (some with malformed times), read back and zip to hours."""
    w = datasets.weather_cache(spark, sf_dir)
    m = (F.col("lat") * 100).cast("int") + F.dayofmonth("hour_utc") * 24 + F.hour("hour_utc")
    path = scratch_path(spark, "landed-weather")
    landed.land_weather_documents(w, path, bad_time=(m % 17 == 0))
    hours = landed.weather_hours_from_documents(landed.read_weather_documents(spark, path))
    return to_portable(hours.drop("landed_at", "doc_path", "idx"))


def stream_ingest_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream landed day files (one file per micro-batch) into raw_incidents."""
    path = _landed_incidents(spark, sf_dir)
    table = scratch_path(spark, "stream-raw")
    q = stream_ingest.start_incident_stream(spark, path, table, scratch_path(spark, "stream-ckpt"),
                                            files_per_trigger=10)
    q.awaitTermination()
    return to_portable(stream_ingest.read_table(spark, table).drop("raw", "inserted_at"))


def _cut_days(name: str = "doc_day"):
    return F.dayofmonth(name) % 3 == 1


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected documents per landing day; every third day's are cut short."""
    path = scratch_path(spark, "landed-cut")
    landed.land_incident_documents(adapters.incident_features(datasets.events(spark, sf_dir)), path, cut=_cut_days())
    return landed.document_account(landed.parsed_documents(landed.read_landed_text(spark, path)))


def upsert_stored_reland(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, ingest, land every second day again (fewer features, other positions and values), ingest, read the stored table."""
    ev = datasets.events(spark, sf_dir)
    root = scratch_path(spark, "reland")
    landed.land_incident_documents(adapters.incident_features(ev), f"{root}/landed", load=1)
    runs.ingest_incidents(spark, f"{root}/landed", f"{root}/raw", f"{root}/log")
    again = ev.where((F.dayofmonth("ts") % 2 == 0) & (F.col("event_id") % 4 != 0)).withColumn("value", F.col("value") + 100)
    landed.land_incident_documents(adapters.incident_features(again), f"{root}/landed", load=2)
    runs.ingest_incidents(spark, f"{root}/landed", f"{root}/raw", f"{root}/log")
    return models.staging(tables.read_raw_incidents(spark, f"{root}/raw")).select("event_id", "objectid", "fatalities")


def upsert_stored_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backfill the cache, land every second day again with other temperatures, backfill what is new, read the cache."""
    w = datasets.weather_cache(spark, sf_dir)
    root = scratch_path(spark, "reland-weather")
    landed.land_weather_documents(w, f"{root}/landed", load=1)
    runs.backfill_weather(spark, f"{root}/landed", f"{root}/cache", f"{root}/log")
    again = w.where(F.dayofmonth("hour_utc") % 2 == 0).withColumn("temperature", (F.col("temperature") + 1).cast("float"))
    landed.land_weather_documents(again, f"{root}/landed", load=2)
    runs.backfill_weather(spark, f"{root}/landed", f"{root}/cache", f"{root}/log", since=1)
    return to_portable(tables.read_weather_cache(spark, f"{root}/cache"))


def _bad_rows():
    """Rows with a planted bad hour: on some days, one feature in fifty."""
    return (F.dayofmonth("doc_day") % 5 == 2) & (F.col("pos") % 50 == 3)


def _ingest_with_bad_days(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    ev = datasets.events(spark, sf_dir)
    landed.land_incident_documents(adapters.incident_features(ev, _bad_rows()), f"{root}/landed", load=1)
    with contextlib.suppress(runs.FailedDays):
        runs.ingest_incidents(spark, f"{root}/landed", f"{root}/raw", f"{root}/log")
    return ev


def ingest_bad_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every landing day when some hold a row with a bad hour, and the stored rows of the day."""
    root = scratch_path(spark, "bad-day")
    _ingest_with_bad_days(spark, sf_dir, root)
    stored = (spark.read.schema(stream_ingest.STREAM_TABLE).parquet(f"{root}/raw").groupBy(F.col("doc_day").alias("day"))
              .agg(F.count("*").alias("stored")))
    days = commit.read_days(spark, f"{root}/raw")
    return (days.join(stored, F.col("doc_day") == F.col("day"), "left")
            .select("doc_day", "status", "n_rows", "n_bad", "reason", F.coalesce("stored", F.lit(0)).cast("long").alias("stored")))


def ingest_bad_day_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table after the failed days were landed again without fault and an incremental run read them."""
    root = scratch_path(spark, "bad-day-again")
    ev = _ingest_with_bad_days(spark, sf_dir, root)
    landed.land_incident_documents(adapters.incident_features(ev.where(F.dayofmonth("ts") % 5 == 2)), f"{root}/landed", load=2)
    runs.ingest_incidents(spark, f"{root}/landed", f"{root}/raw", f"{root}/log", incremental=True)
    return to_portable(tables.read_raw_incidents(spark, f"{root}/raw").select("event_id", "objectid", "occ_date_utc"))


def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours without latitude: left out and counted, or an error that leaves the table as it was (one row for each way)."""
    root = scratch_path(spark, "null-keys")
    lost = datasets.weather_cache(spark, sf_dir).withColumn("lat", F.when(F.hour("hour_utc") % 12 != 5, F.col("lat"))).withColumn("doc", F.lit(0))
    out = []
    for way in ("drop", "error"):
        counts = (0, 0, 0)
        with contextlib.suppress(Exception), runlog.run_logged(spark, f"{root}/log", way):
            counts = tuple(upsert.upsert_table(spark, f"{root}/{way}", lost, WEATHER_CACHE, ["lat", "lon", "hour_utc"], ["doc"],
                                               tables.WEATHER_PARTITIONING, null_keys=way).first())
        out.append((way, *counts, tables.read_weather_cache(spark, f"{root}/{way}").count()))
    out = spark.createDataFrame(out, "way string, rows_upserted long, distinct_keys long, null_keys long, stored long")
    state = tables.read_run_log(spark, f"{root}/log")
    names = F.coalesce(F.col("error_message").contains("key column lat"), F.lit(False)).alias("names_column")
    return out.join(state.select(F.col("pipeline_name").alias("way"), "status", names), "way")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of the stream by day and reason: documents cut short on every third day, rows with a bad hour on the others."""
    root = scratch_path(spark, "stream-rejects")
    landed.land_incident_documents(adapters.incident_features(datasets.events(spark, sf_dir), _bad_rows()), f"{root}/landed", cut=_cut_days())
    stream_ingest.start_incident_stream(spark, f"{root}/landed", f"{root}/raw", f"{root}/checkpoint", files_per_trigger=20,
                                        run_log_path=f"{root}/log").awaitTermination()
    return commit.read_dead_letters(spark, f"{root}/raw").groupBy("doc_day", "reason").agg(F.count("*").alias("n"))


def backfill_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log of three incremental backfills: all hours, every second day landed again, nothing new; and the landings loaded so far."""
    w = datasets.weather_cache(spark, sf_dir)
    root = scratch_path(spark, "backfill-incremental")
    landed.land_weather_documents(w, f"{root}/landed", load=1)
    for again in (w.where(F.dayofmonth("hour_utc") % 2 == 0), None, None):
        runs.backfill_weather(spark, f"{root}/landed", f"{root}/cache", f"{root}/log", incremental=True)
        if again is not None:
            landed.land_weather_documents(again, f"{root}/landed", load=2)
    loaded = spark.read.schema(runs.LOADED).parquet(f"{root}/cache.landings").groupBy("run_id").agg(F.max("load").alias("landing"))
    return (tables.read_run_log(spark, f"{root}/log").join(loaded, "run_id", "left")
            .select("status", "row_count", F.col("error_message").isNotNull().alias("has_message"), "landing"))


def _jobs(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    """Landing, ingest, backfill and models on files; the folder and the models' paths."""
    ev = datasets.events(spark, sf_dir)
    root = scratch_path(spark, "jobs")
    landed.land_incident_documents(adapters.incident_features(ev), f"{root}/landed/incidents")
    landed.land_weather_documents(adapters.weather_hours(ev), f"{root}/landed/weather")
    runs.ingest_incidents(spark, f"{root}/landed/incidents", f"{root}/raw", f"{root}/log")
    runs.backfill_weather(spark, f"{root}/landed/weather", f"{root}/cache", f"{root}/log")
    return root, runs.build_models(spark, f"{root}/raw", f"{root}/cache", f"{root}/models", f"{root}/log")


def jobs_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored mart after the jobs ran on landed files."""
    _, paths = _jobs(spark, sf_dir)
    return to_portable(tables.read_model(spark, paths["fct_incidents_flat"]).drop("inserted_at"))


def run_log_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every run after the jobs, one of which fails on rejected documents (ids and clocks left out)."""
    root, _ = _jobs(spark, sf_dir)
    landed.land_incident_documents(adapters.incident_features(datasets.events(spark, sf_dir)), f"{root}/cut", cut=_cut_days())
    with contextlib.suppress(runs.RejectedDocuments):
        runs.ingest_incidents(spark, f"{root}/cut", f"{root}/raw", f"{root}/log", triggered_by="check", strict=True)
    state = tables.read_run_log(spark, f"{root}/log")
    ended = (F.col("end_time") >= F.col("start_time")) & F.col("duration").isNotNull()
    return state.select("pipeline_name", "status", "row_count", "triggered_by", ended.alias("ended"),
                        F.col("error_message").isNotNull().alias("has_message"))


def dq_report_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on rows with planted faults: NULL and repeated keys, bad and missing status values."""
    ev = datasets.events(spark, sf_dir)
    batch = datasets.incident_batch(spark, sf_dir).select(F.when(F.col("pos") % 13 != 0, F.col("event_id")).alias("event_id"))
    status = (adapters.run_log_rows(ev).select(F.when(F.expr("cast(substr(run_id, 5) as bigint) % 17 = 0"), F.lit("lost"))
                                               .when(F.expr("cast(substr(run_id, 5) as bigint) % 19 <> 0"), F.col("status")).alias("status")))
    none = batch.where("false")
    return quality.report([quality.key_checks(batch, "batch", ["event_id"]),
                           quality.accepted_values(status, "run_log", "status", RUN_STATUSES),
                           quality.non_empty(none, "empty"), quality.has_column(batch, "batch", "objectid")])
