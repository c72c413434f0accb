"""Run the jobs on files end to end and compare the stored mart with ``fct_flat``.

Usage: python tools/end_to_end.py [sf_dir]
Lands incident pages and weather documents derived from ``events`` under the
shared checkpoint folder, ingests, backfills, builds the models from the stored
tables, exports, and checks that the stored mart equals the in-memory one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(spark, sf_dir: str) -> dict:
    from pyspark.sql import functions as F

    from squall.plans import datasets, queries, runs
    from squall.plans.portable import to_portable
    from squall.session import scratch_path
    from squall.sources import adapters, landed, tables

    root = scratch_path(spark, "e2e")
    ev = datasets.events(spark, sf_dir)
    landed.land_incident_documents(adapters.incident_features(ev), f"{root}/landed/incidents")
    landed.land_weather_documents(adapters.weather_hours(ev), f"{root}/landed/weather")
    log = f"{root}/run_log"
    raw, wx = f"{root}/raw_incidents", f"{root}/weather_cache"
    ingested = runs.ingest_incidents(spark, f"{root}/landed/incidents", raw, log).first()
    runs.backfill_weather(spark, f"{root}/landed/weather", wx, log)
    paths = runs.build_models(spark, raw, wx, f"{root}/models")
    n_export = runs.export_mart(spark, paths["fct_incidents_flat"], f"{root}/export", log)
    stored = to_portable(tables.read_model(spark, paths["fct_incidents_flat"])).drop("inserted_at")
    memory = queries.fct_flat(spark, sf_dir).drop("inserted_at")
    diff = stored.exceptAll(memory).count() + memory.exceptAll(stored).count()
    states = tables.read_run_log(spark, log).groupBy("status").count().collect()
    return {"rows_upserted": ingested["rows_upserted"], "mart_rows": stored.count(),
            "exported": n_export, "mart_differences": diff,
            "runs": {r["status"]: r["count"] for r in states},
            "plan_after_backfill": runs.plan_weather(spark, raw, wx).count(),
            "null_weather_rows": stored.filter(F.col("temperature").isNull()).count()}


if __name__ == "__main__":
    from squall.session import build_session
    s = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    print(run(s, sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"))
