"""The three entry points end to end on the fixtures."""

import os

from conftest import incident_fixture, land_json, weather_fixture
from squall.plans import runs
from squall.sources import tables


def test_ingest_backfill_models_export(spark, scratch):
    landed_inc = land_json(os.path.join(scratch, "landed"), "year=2024/month=01/day=18", incident_fixture())
    raw, weather = os.path.join(scratch, "raw"), os.path.join(scratch, "weather")
    log = os.path.join(scratch, "run_log")
    counts = runs.ingest_incidents(spark, landed_inc, raw, log, triggered_by="test").first()
    assert counts.rows_upserted == 3
    plan = runs.plan_weather(spark, raw, weather).collect()
    assert len(plan) == 3
    # the fixture's weather document covers the first incident's grid point (43.72, -79.41)
    land_json(os.path.join(scratch, "wx"), "lat=43.72/lon=-79.41", weather_fixture(), "w.json")
    runs.backfill_weather(spark, os.path.join(scratch, "wx"), weather, log)
    assert tables.read_weather_cache(spark, weather).count() == 24
    assert len(runs.plan_weather(spark, raw, weather).collect()) == 2
    paths = runs.build_models(spark, raw, weather, os.path.join(scratch, "models"))
    mart = tables.read_model(spark, paths["fct_incidents_flat"])
    rows = {r.event_id: r for r in mart.collect()}
    assert len(rows) == 3 and rows["T-704"].weather_condition == "Cloudy"
    assert abs(rows["T-704"].temperature + 1.3) < 1e-6  # 08:00 UTC
    assert rows["T-91"].weather_condition == "Other"
    n = runs.export_mart(spark, paths["fct_incidents_flat"], os.path.join(scratch, "csv"), log)
    assert n == 3
    one = os.path.join(scratch, "one", "incidents.csv")
    assert runs.export_mart(spark, paths["fct_incidents_flat"], one, log, order=["event_id"]) == 3
    with open(one) as f:
        assert sorted(rows) == [line.split(",")[0] for line in f.read().splitlines()[1:]]
    state = tables.read_run_log(spark, log).collect()
    assert sorted(r.pipeline_name for r in state) == ["export_for_tableau", "export_for_tableau", "tps_ingest", "weather_cache"]
    assert all(r.status == "success" for r in state)


def test_incremental_ingest_resumes_after_high_water_mark(spark, scratch):
    root = os.path.join(scratch, "landed")
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    raw, log = os.path.join(scratch, "raw"), os.path.join(scratch, "run_log")
    assert runs.ingest_incidents(spark, root, raw, log, incremental=True).first().rows_upserted == 3
    # day 18 is at or before the high-water mark (2024-01-19 03:00 UTC = 22:00 local): skipped
    land_json(root, "year=2024/month=01/day=19", incident_fixture(), "more.json")
    again = runs.ingest_incidents(spark, root, raw, log, incremental=True).first()
    assert again.rows_upserted == 3  # only the new day's three features
    assert tables.read_raw_incidents(spark, raw).count() == 3


def test_models_as_sql_views(spark, scratch):
    from squall.operators import ingest, upsert
    from squall.plans import models
    from squall.schemas import RAW_INCIDENTS, WEATHER_CACHE
    from squall.sources import landed
    root = land_json(os.path.join(scratch, "landed"), "year=2024/month=01/day=18", incident_fixture())
    raw = upsert.merge_last_wins(None, ingest.normalise_incidents(landed.read_incident_documents(spark, root)),
                                 ["event_id"], list(ingest.ORDER_COLUMNS), ("inserted_at",),
                                 [f.name for f in RAW_INCIDENTS.fields])
    models.register_views(raw, spark.createDataFrame([], WEATHER_CACHE))
    got = spark.sql("SELECT daypart, count(*) AS n FROM fct_incidents_flat GROUP BY daypart "
                    "ORDER BY daypart").collect()
    assert [(r.daypart, r.n) for r in got] == [("Evening", 1), ("Morning", 1), ("Night", 1)]
    assert spark.sql("SELECT count(*) AS n FROM stg_tps_incidents WHERE injury_collisions").first().n == 1


def test_jobs_on_files_equal_the_in_memory_mart(spark):
    from tools.end_to_end import run
    out = run(spark, "/root/testdata/sf0.001")
    assert out["mart_differences"] == 0
    assert out["mart_rows"] == out["exported"] > 0
    assert out["runs"] == {"success": 3}


def test_relanded_older_day_wins_and_replays_change_nothing(spark, scratch):
    import time

    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    later = {"features": [dict(f, attributes=dict(f["attributes"], DIVISION="later")) for f in incident_fixture()["features"][1:2]]}
    land_json(root, "year=2024/month=01/day=25", later)
    runs.ingest_incidents(spark, root, raw, log)
    time.sleep(0.05)
    fixed = {"features": [dict(f, attributes=dict(f["attributes"], OBJECTID=900)) for f in incident_fixture()["features"][1:]]}
    land_json(root, "year=2024/month=01/day=18", fixed)      # fewer features, shifted by one
    for _ in range(2):
        runs.ingest_incidents(spark, root, raw, log)
        got = {r.event_id: r.objectid for r in tables.read_raw_incidents(spark, raw).collect()}
        assert got == {"T-704": 300, "T-91": 900, "T-5522": 900}


def test_newer_weather_document_wins_whatever_its_name(spark, scratch):
    import copy
    import time

    grid, cache, log = "lat=43.72/lon=-79.41", os.path.join(scratch, "cache"), os.path.join(scratch, "log")
    root = land_json(os.path.join(scratch, "wx"), grid, weather_fixture(), "z-first.json")
    time.sleep(0.05)
    newer = copy.deepcopy(weather_fixture())
    newer["hourly"]["temperature_2m"] = [20.5] * 24
    newer["hourly"]["cloudcover"] += [1, 2]                  # longer than time: cut
    land_json(os.path.join(scratch, "wx"), grid, newer, "a-second.json")
    runs.backfill_weather(spark, root, cache, log)
    assert {r.temperature for r in tables.read_weather_cache(spark, cache).collect()} == {20.5}


def test_rejected_documents_are_counted_and_strict_mode_fails(spark, scratch):
    import json

    import pytest

    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    with open(os.path.join(root, "year=2024/month=01/day=18", "cut.json"), "w") as f:
        f.write(json.dumps(incident_fixture())[:200] + "\n\n{\"page\": 1}\n")
    with pytest.raises(runs.RejectedDocuments):
        runs.ingest_incidents(spark, root, raw, log, strict=True)
    assert not os.path.exists(raw)
    assert runs.ingest_incidents(spark, root, raw, log).first().rows_upserted == 3
    state = {r.status: r.error_message for r in tables.read_run_log(spark, log).collect()}
    assert state["success"] == "rejected documents: 1 no features, 1 unparsable" and "unparsable" in state["failure"]


def test_pretty_printed_documents_reach_the_table(spark, scratch):
    import json

    raw, log = os.path.join(scratch, "raw"), os.path.join(scratch, "log")
    d = os.path.join(scratch, "landed", "year=2024/month=01/day=18")
    os.makedirs(d)
    with open(os.path.join(d, "i.json"), "w") as f:
        json.dump(incident_fixture(), f, indent=1)
    assert runs.ingest_incidents(spark, os.path.join(scratch, "landed"), raw, log, wholetext=True).first().rows_upserted == 3


def test_interrupted_swap_is_finished_by_the_next_upsert(spark, scratch):
    from squall.operators import upsert

    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    finish, upsert.finish_swaps = upsert.finish_swaps, lambda *a: None
    try:
        runs.ingest_incidents(spark, root, raw, log)         # merged and marked ready, never moved
    finally:
        upsert.finish_swaps = finish
    assert tables.read_raw_incidents(spark, raw).count() == 0
    upsert.finish_swaps(spark, raw)
    assert tables.read_raw_incidents(spark, raw).count() == 3 and not os.path.exists(f"{raw}.staging")


def test_full_refresh_drops_old_partitions_and_float_text_is_plain(spark, scratch):
    from squall.operators import export
    from squall.plans import models

    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    path = os.path.join(scratch, "m")
    models.materialise(df, path, ["p"])
    models.materialise(df.where("p = 'a'"), path, ["p"])
    assert spark.read.parquet(path).count() == 1
    floats = spark.createDataFrame([(0.1,), (-3.7,), (0.0004,), (12.0,), (1e10,), (None,), (1e-5,)], "f float")
    assert [r.f for r in export.csv_text(floats).collect()] == ["0.1", "-3.7", "0.0004", "12.0", "10000000000.0", None, "0.00001"]
    spaced = spark.createDataFrame([(" lead", "trail ", "two\nlines")], "a string, b string, c string")
    export.write_csv(spaced, os.path.join(scratch, "csv"))
    assert tuple(export.read_csv(spark, os.path.join(scratch, "csv"), spaced.schema).first()) == (" lead", "trail ", "two\nlines")


def test_failing_model_checks_stop_and_are_logged(spark, scratch, monkeypatch):
    import pytest

    from squall.operators import quality
    root, raw, cache, log = (os.path.join(scratch, n) for n in ("landed", "raw", "cache", "log"))
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    runs.ingest_incidents(spark, root, raw, log)
    land_json(os.path.join(scratch, "wx"), "lat=43.72/lon=-79.41", weather_fixture(), "w.json")
    runs.backfill_weather(spark, os.path.join(scratch, "wx"), cache, log)
    monkeypatch.setattr(quality, "non_empty", lambda df, model: quality.not_null(df, model, "windspeed"))
    with pytest.raises(runs.FailedChecks):
        runs.build_models(spark, raw, cache, os.path.join(scratch, "models"), log)
    failed = tables.read_run_log(spark, log).where("status = 'failure'").collect()
    assert len(failed) == 1 and "windspeed" in failed[0].error_message
