"""The reference's three entry points as Spark jobs, each under the run log.

- ``ingest_incidents``: landed day files -> normalise -> upsert ``raw_incidents``.
- ``backfill_weather``: landed weather documents -> hourly rows -> upsert
  ``weather_cache``; ``plan_weather`` says which documents are still needed.
- ``build_models`` / ``export_mart``: staging -> enriched -> mart tables, CSV.

The driver only resolves dates and paths; every data step is a distributed
job. A failure is logged with its message and re-raised (D7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from squall.operators import commit, export, onefile, quality
from squall.operators.commit import RejectedDocuments  # noqa: F401
from squall.operators.runlog import DEFAULT_TRIGGER, run_logged
from squall.operators.upsert import remove, table_exists, upsert_table
from squall.plans import models, requests
from squall.schemas import WEATHER_CACHE
from squall.session import ensure_utc, scratch_path
from squall.sources import landed, tables


class FailedDays(ValueError):
    """Days that were not stored because a row of theirs is bad; the other days are."""


def ingest_incidents(spark: SparkSession, landed_path: str, raw_path: str, run_log_path: str,
                     start_day: str | None = None, end_day: str | None = None,
                     triggered_by: str = DEFAULT_TRIGGER, lenient: bool = False,
                     incremental: bool = False, wholetext: bool = False, strict: bool = False,
                     on_failed_day: str = "raise") -> DataFrame:
    """Upsert every landed day in ``[start_day, end_day]`` (all days if unset).

    ``incremental=True`` without ``start_day`` resumes at the local day after the
    stored high-water mark (the project baseline when the table is empty), as
    the reference's fetcher does, and reads the days again whose latest outcome is a failure;
    only those dates reach the driver.
    The day is the unit of commit: a bad value (one that the strict reading raises on) keeps its day
    out of the table and no other; the day log and the dead letters tell which (``commit``).
    The run then is a failure that counts the rows it stored, raised as ``FailedDays``, or with
    ``on_failed_day="log"`` a success whose message names the days. ``lenient`` reads bad values as NULL.
    Rejected documents are counted in the run's message; ``strict`` fails before
    anything is written. ``wholetext`` for files of one document over several lines.
    Returns the batch counts (rows upserted incl. in-batch repeats, distinct keys,
    rows without key)."""
    ensure_utc(spark)
    if on_failed_day not in ("raise", "log"):
        raise ValueError("on_failed_day is 'raise' or 'log'")
    with run_logged(spark, run_log_path, "tps_ingest", triggered_by) as ctx:
        again = []
        if incremental and start_day is None:
            stored = tables.read_raw_incidents(spark, raw_path) if table_exists(spark, raw_path) else None
            start_day = requests.resolve_start(spark, None, stored).first()["start_day"].isoformat()
            again = commit.open_days(spark, raw_path)
        parsed = landed.parsed_documents(landed.read_landed_text(spark, landed_path, start_day, end_day, wholetext, again))
        done = commit.commit_landed(spark, parsed, raw_path, ctx["run_id"], lenient, strict)
        ctx["row_count"], ctx["message"] = done.rows_upserted, done.message()
        if done.failed and on_failed_day == "raise":
            raise FailedDays(done.message())
    return spark.createDataFrame([(done.rows_upserted, done.distinct_keys, done.null_keys)], "rows_upserted long, distinct_keys long, null_keys long")


def plan_weather(spark: SparkSession, raw_path: str, weather_path: str, exact: bool = False) -> DataFrame:
    """Requests still needed to cover every incident's (grid point, day)."""
    raw = tables.read_raw_incidents(spark, raw_path)
    weather = (tables.read_weather_cache(spark, weather_path) if table_exists(spark, weather_path)
               else spark.createDataFrame([], WEATHER_CACHE))
    return requests.weather_plan(raw, weather, exact)


def backfill_weather(spark: SparkSession, landed_path: str, weather_path: str, run_log_path: str,
                     triggered_by: str = DEFAULT_TRIGGER, since: int | None = None, multiline: bool = False,
                     strict: bool = False, incremental: bool = False) -> DataFrame:
    """Upsert landed weather documents into the cache: all, or those landed after ``since``. Where two
    documents hold the same hour, the one landed later wins, then the later array entry.

    ``incremental``: the finished landings that no earlier incremental run has loaded (in whatever
    order they were finished); only their folders are listed and read. Documents are read once:
    rejected ones are counted on the way (``strict`` fails before anything is stored)."""
    ensure_utc(spark)
    with run_logged(spark, run_log_path, "weather_cache", triggered_by) as ctx:
        loads = None
        if incremental:
            loads = sorted(set(landed.landings(spark, landed_path)) - _loaded(spark, weather_path))
        counts = {"rows_upserted": 0, "distinct_keys": 0, "null_keys": 0}
        if loads is None or loads:
            counts = _load_weather(spark, landed_path, weather_path, since, multiline, strict, loads, ctx)
        if loads:
            (spark.createDataFrame([(n, ctx["run_id"]) for n in loads], LOADED).coalesce(1)
             .write.mode("append").parquet(f"{weather_path.rstrip('/')}.landings"))
    return spark.createDataFrame([tuple(counts.values())], "rows_upserted long, distinct_keys long, null_keys long")


LOADED = "load long, run_id string"


def _loaded(spark: SparkSession, weather_path: str) -> set[int]:
    """Numbers of the landings in the cache: one for each incremental load."""
    path = f"{weather_path.rstrip('/')}.landings"
    if not table_exists(spark, path):
        return set()
    return {r["load"] for r in spark.read.schema(LOADED).parquet(path).collect()}


def _load_weather(spark: SparkSession, landed_path: str, weather_path: str, since: int | None, multiline: bool, strict: bool,
                  loads: list[int] | None, ctx: dict) -> dict[str, int]:
    documents = Observation()
    parsed = landed.parsed_weather_documents(spark, landed_path, multiline, since, loads)
    watched = parsed.observe(documents, *[F.count_if(F.col("reason") == r).alias(r) for r in landed.WEATHER_REASONS])
    hours = landed.weather_hours_from_documents(landed.accepted_weather(watched))
    staged = scratch_path(spark, "weather-hours")
    try:
        hours.write.parquet(staged)
        hours = spark.read.schema(hours.schema).parquet(staged)
        rejects = ", ".join(f"{n} {reason}" for reason, n in sorted(documents.get.items()) if n)
        if rejects:
            ctx["message"] = f"rejected documents: {rejects}"
            if strict:
                raise commit.RejectedDocuments(ctx["message"])
        counts = upsert_table(spark, weather_path, hours, WEATHER_CACHE, ["lat", "lon", "hour_utc"],
                              ["landed_at", "doc_path", "idx"], tables.WEATHER_PARTITIONING, staged=True).first().asDict()
    finally:
        remove(spark, staged)
    ctx["row_count"] = counts["rows_upserted"]
    return counts


class FailedChecks(ValueError):
    """Model checks that did not pass."""


def build_models(spark: SparkSession, raw_path: str, weather_path: str, out_dir: str,
                 run_log_path: str | None = None, triggered_by: str = DEFAULT_TRIGGER) -> dict[str, str]:
    """Materialise the enriched model and the mart as full-refresh tables (K7);
    staging stays a view (K6). The models' checks run on what was written (D1, D2, D5);
    a failing one is an error, logged if there is a run log."""
    if run_log_path is not None:
        with run_logged(spark, run_log_path, "build_models", triggered_by):
            return build_models(spark, raw_path, weather_path, out_dir)
    ensure_utc(spark)
    raw = tables.read_raw_incidents(spark, raw_path)
    weather = tables.read_weather_cache(spark, weather_path)
    stg = models.as_view(models.staging(raw), "stg_tps_incidents")
    paths = {"int_enriched_incidents": f"{out_dir.rstrip('/')}/int_enriched_incidents",
             "fct_incidents_flat": f"{out_dir.rstrip('/')}/fct_incidents_flat"}
    models.materialise(models.enrich(stg, weather), paths["int_enriched_incidents"],
                       sort_by=["occ_date_utc"])
    enriched = tables.read_model(spark, paths["int_enriched_incidents"])
    models.materialise(models.mart(enriched), paths["fct_incidents_flat"], sort_by=["occ_date_utc"])
    marts = tables.read_model(spark, paths["fct_incidents_flat"])
    checks = quality.report([quality.key_checks(weather, "weather_cache", ["lat", "lon", "hour_utc"]),
                             quality.key_checks(stg, "stg_tps_incidents", ["event_id"]),
                             quality.key_checks(enriched, "int_enriched_incidents", ["event_id"]),
                             quality.key_checks(marts, "fct_incidents_flat", ["event_id"]),
                             quality.non_empty(marts, "fct_incidents_flat")])
    failed = [f"{r['model']}.{r['check']}({r['column']}): {r['failures']}" for r in checks.where("not passed").collect()]
    if failed:
        raise FailedChecks("; ".join(failed))
    return paths


def export_mart(spark: SparkSession, mart_path: str, out_path: str, run_log_path: str,
                triggered_by: str = DEFAULT_TRIGGER, single_file: bool = False, order: list[str] | None = None) -> int:
    """Export the mart to CSV under the run log; returns the row count.

    ``out_path`` is a folder of parts; with ``order`` it is one file in that order, written by all tasks."""
    ensure_utc(spark)
    with run_logged(spark, run_log_path, "export_for_tableau", triggered_by) as ctx:
        mart = tables.read_model(spark, mart_path)
        if order is not None:
            onefile.write_csv_file(mart, out_path, order)
        else:
            export.write_csv(mart, out_path, single_file=single_file)
        ctx["row_count"] = mart.count()
    return ctx["row_count"]
