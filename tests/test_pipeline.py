"""Ingest, upsert, weather documents, gaps, plans, export, run log, streaming."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import incident_fixture, land_json, weather_fixture
from squall.operators import export, gaps, ingest, quality, runlog, upsert
from squall.plans import models, requests
from squall.schemas import RAW_INCIDENTS, WEATHER_CACHE
from squall.sources import landed
from squall.streaming import ingest as stream_ingest


def _landed_fixture(scratch):
    return land_json(scratch, "year=2024/month=01/day=18", incident_fixture())


def test_incident_fixture_normalises(spark, scratch):
    feats = landed.read_incident_documents(spark, _landed_fixture(scratch), wholetext=True)
    rows = ingest.normalise_incidents(feats).orderBy("pos").collect()
    assert len(rows) == 3
    assert [r.event_id for r in rows] == ["T-704", "T-91", "T-5522"]
    assert [r.occ_date_utc for r in rows] == [datetime(2024, 1, 18, 8), datetime(2024, 1, 18, 16),
                                              datetime(2024, 1, 19, 3)]
    assert all(r.lat is not None and r.lon is not None and r.objectid for r in rows)
    assert rows[0].doc_day == date(2024, 1, 18)


def test_unusable_coordinates_stored_null_and_still_counted(spark, scratch):
    def feature(event_id, lat, lon):
        return {"attributes": {"EVENT_UNIQUE_ID": event_id, "LAT_WGS84": lat, "LONG_WGS84": lon}}

    doc = {"features": [feature("T-1", 0.0, 0), feature("T-2", 43.71, None), feature("T-3", 0, -79.44), feature("T-4", "43.5", "-79.5")]}
    feats = landed.read_incident_documents(spark, land_json(scratch, "year=2024/month=01/day=19", doc))
    rows = {r.event_id: (r.lat, r.lon) for r in ingest.normalise_incidents(feats).collect()}
    assert [k for k, v in rows.items() if v == (None, None)] == ["T-1", "T-2"]
    assert (float(rows["T-3"][0]), float(rows["T-4"][0])) == (0.0, 43.5)
    c = ingest.ingest_counts(feats).first()
    assert (c.n_features, c.n_upserted, c.n_null_coords, c.n_no_date) == (4, 4, 2, 4)


def test_missing_id_skipped_and_bad_hour_strict(spark, scratch):
    doc = {"features": [{"attributes": {"OBJECTID": 1, "EVENT_UNIQUE_ID": ""}},
                        {"geometry": {"x": 1, "y": 2}},
                        {"attributes": {"OBJECTID": 3, "EVENT_UNIQUE_ID": "T-5522",
                                        "OCC_DATE": 1704085200000, "OCC_HOUR": "NSA"}}]}
    feats = landed.read_incident_documents(spark, land_json(scratch, "year=2024/month=01/day=20", doc))
    c = ingest.ingest_counts(feats).first()
    assert (c.n_features, c.n_upserted, c.n_skipped_no_id) == (3, 1, 2)
    with pytest.raises(Exception):
        ingest.normalise_incidents(feats).collect()
    lenient = ingest.normalise_incidents(feats, lenient=True).collect()
    assert len(lenient) == 1 and lenient[0].occ_date_utc is not None


def _raw_schema_cols():
    return [f.name for f in RAW_INCIDENTS.fields]


def test_last_wins_in_batch_keeps_first_inserted_at(spark, scratch):
    feats = landed.read_incident_documents(spark, _landed_fixture(scratch))
    b1 = ingest.normalise_incidents(feats, inserted_at="2024-02-01 00:00:00")
    stored = upsert.merge_last_wins(None, b1, ["event_id"], list(ingest.ORDER_COLUMNS),
                                    ("inserted_at",), _raw_schema_cols())
    # a later batch: the same key twice, the second copy wins
    b2 = (b1.filter("event_id = 'T-704'").withColumn("objectid", F.lit(7))
          .unionByName(b1.filter("event_id = 'T-704'").withColumn("objectid", F.lit(8))
                       .withColumn("pos", F.col("pos") + 1))
          .withColumn("inserted_at", F.lit("2024-03-01 00:00:00").cast("timestamp")))
    out = {r.event_id: r for r in upsert.merge_last_wins(
        stored, b2, ["event_id"], list(ingest.ORDER_COLUMNS), ("inserted_at",),
        _raw_schema_cols()).collect()}
    assert len(out) == 3
    assert out["T-704"].objectid == 8
    assert out["T-704"].inserted_at == datetime(2024, 2, 1)


def test_upsert_table_idempotent_and_incremental(spark, scratch):
    root = os.path.join(scratch, "landed")
    land_json(root, "year=2024/month=01/day=18", incident_fixture())
    table = os.path.join(scratch, "raw")
    feats = landed.read_incident_documents(spark, root)
    for _ in range(2):  # replaying the same batch changes nothing
        stream_ingest.upsert_batch(spark, table, feats)
    t = spark.read.schema(stream_ingest.STREAM_TABLE).parquet(table)
    assert t.count() == 3
    first_inserted = {r.event_id: r.inserted_at for r in t.collect()}
    assert os.path.isdir(os.path.join(table, "occ_month=2024-01"))
    # T-91 is re-delivered on a later landing day with a March date: it moves
    # from the January partition to March; January keeps T-704 and T-5522.
    moved = {"features": [dict(incident_fixture()["features"][1])]}
    moved["features"][0]["attributes"] = dict(moved["features"][0]["attributes"],
                                              OCC_DATE=1709269200000, OBJECTID=42)
    root2 = land_json(os.path.join(scratch, "landed2"), "year=2024/month=03/day=01", moved)
    stream_ingest.upsert_batch(spark, table, landed.read_incident_documents(spark, root2))
    t = {r.event_id: r for r in spark.read.schema(stream_ingest.STREAM_TABLE).parquet(table).collect()}
    assert len(t) == 3 and t["T-91"].objectid == 42 and t["T-91"].occ_month == "2024-03"
    assert t["T-91"].inserted_at == first_inserted["T-91"]
    assert {t["T-704"].occ_month, t["T-5522"].occ_month} == {"2024-01"}
    # all of January's rows move: the January partition is removed
    all_moved = {"features": [dict(f, attributes=dict(f["attributes"], OCC_DATE=1709269200000))
                              for f in incident_fixture()["features"]]}
    root3 = land_json(os.path.join(scratch, "landed3"), "year=2024/month=03/day=02", all_moved)
    stream_ingest.upsert_batch(spark, table, landed.read_incident_documents(spark, root3))
    t = spark.read.schema(stream_ingest.STREAM_TABLE).parquet(table)
    assert t.count() == 3 and {r.occ_month for r in t.collect()} == {"2024-03"}
    assert not os.path.exists(os.path.join(table, "occ_month=2024-01"))


def test_weather_document_rows_and_upsert(spark, scratch):
    root = land_json(scratch, "lat=43.61/lon=-79.56", weather_fixture(), "weather.json")
    docs = landed.read_weather_documents(spark, root)
    hours = landed.weather_hours_from_documents(docs)
    rows = hours.collect()
    assert len(rows) == 24
    assert all(float(r.lat) == 43.61 and float(r.lon) == -79.56 for r in rows)
    assert {r.date_utc for r in rows} == {date(2024, 1, 18)}
    table = os.path.join(scratch, "weather_cache")
    for _ in range(2):
        upsert.upsert_table(spark, table, hours.withColumn("doc", F.lit(0)), WEATHER_CACHE,
                            ["lat", "lon", "hour_utc"], ["doc"], ["date_utc"])
    assert spark.read.schema(WEATHER_CACHE).parquet(table).count() == 24
    cond = models.enrich(
        spark.createDataFrame([], models.staging(spark.createDataFrame([], RAW_INCIDENTS)).schema),
        hours)
    assert "weather_condition" in cond.columns


def test_pretty_printed_documents(spark, scratch):
    import json
    d = os.path.join(scratch, "wx", "lat=43.61", "lon=-79.56")
    os.makedirs(d)
    with open(os.path.join(d, "w.json"), "w") as f:
        json.dump(weather_fixture(), f, indent=2)
    docs = landed.read_weather_documents(spark, os.path.join(scratch, "wx"), multiline=True)
    assert landed.weather_hours_from_documents(docs).count() == 24
    d = os.path.join(scratch, "inc", "year=2024", "month=01", "day=18")
    os.makedirs(d)
    with open(os.path.join(d, "incidents.json"), "w") as f:
        json.dump(incident_fixture(), f, indent=2)
    feats = landed.read_incident_documents(spark, os.path.join(scratch, "inc"), wholetext=True)
    assert ingest.normalise_incidents(feats).count() == 3


def test_weather_unequal_arrays_fail_malformed_time_dropped(spark, scratch):
    bad = weather_fixture()
    bad["hourly"]["temperature_2m"] = bad["hourly"]["temperature_2m"][:23]
    root = land_json(os.path.join(scratch, "a"), "lat=43.61/lon=-79.56", bad, "w.json")
    with pytest.raises(Exception):
        landed.weather_hours_from_documents(landed.read_weather_documents(spark, root)).collect()
    odd = weather_fixture()
    odd["hourly"]["time"][5] = "garbage"
    root = land_json(os.path.join(scratch, "b"), "lat=43.61/lon=-79.56", odd, "w.json")
    assert landed.weather_hours_from_documents(landed.read_weather_documents(spark, root)).count() == 23


def _raw_from_fixture(spark, scratch):
    feats = landed.read_incident_documents(spark, _landed_fixture(scratch))
    b = ingest.normalise_incidents(feats, inserted_at="2024-02-01 12:30:00.250001")
    return upsert.merge_last_wins(None, b, ["event_id"], list(ingest.ORDER_COLUMNS), ("inserted_at",),
                                  _raw_schema_cols())


def test_gap_target_and_force_plan(spark, scratch):
    raw = _raw_from_fixture(spark, scratch)
    empty = spark.createDataFrame([], WEATHER_CACHE)
    ranges = gaps.missing_ranges(raw, empty).collect()
    assert sorted(r.start_date for r in ranges) == [date(2024, 1, 18), date(2024, 1, 18), date(2024, 1, 19)]
    forced = requests.weather_force(spark, 43.61, -79.56, "2024-01-01").first()
    assert (float(forced.lat_r), float(forced.lon_r)) == (43.61, -79.56)
    assert "latitude=43.61&longitude=-79.56&start_date=2024-01-01&end_date=2024-01-01" in forced.url


def test_exact_islands_split_ranges(spark):
    raw = spark.createDataFrame(
        [(f"GO-{i}", datetime(2024, 1, d, 12), "43.61", "-79.56") for i, d in enumerate([1, 2, 5, 6, 9])],
        "event_id string, occ_date_utc timestamp, lat string, lon string").select(
        "event_id", "occ_date_utc", F.col("lat").cast("decimal(9,6)").alias("lat"),
        F.col("lon").cast("decimal(9,6)").alias("lon"))
    empty = spark.createDataFrame([], WEATHER_CACHE)
    assert gaps.missing_ranges(raw, empty).count() == 1
    isl = [(r.start_date.day, r.end_date.day) for r in gaps.missing_ranges(raw, empty, exact=True).collect()]
    assert isl == [(1, 2), (5, 6), (9, 9)]


def test_incident_day_plan_quarter_default_and_bad_range(spark):
    start = requests.resolve_start(spark, "2024-01-01")
    plan = requests.incident_days(start).collect()
    assert len(plan) == 91 and plan[-1].local_day == date(2024, 3, 31)
    assert requests.resolve_start(spark).first().start_day == date(2024, 1, 1)
    with pytest.raises(Exception):
        requests.incident_days(start, "2023-12-31").collect()


def test_export_csv_roundtrip_and_quality(spark, scratch):
    raw = _raw_from_fixture(spark, scratch)
    mart = models.build_mart(raw, spark.createDataFrame([], WEATHER_CACHE))
    out = os.path.join(scratch, "export")
    export.write_csv(mart, out, single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    header = open(os.path.join(out, files[0])).readline().strip().split(",")
    assert "event_id" in header
    back = export.read_csv(spark, out, mart.schema)
    assert back.count() == 3
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, mart.collect()))
    rep = quality.report([quality.not_null(mart, "m", "event_id"), quality.unique(mart, "m", ["event_id"]),
                          quality.non_empty(mart, "m")]).collect()
    assert all(r.passed for r in rep)


def test_run_log_lifecycle(spark, scratch):
    path = os.path.join(scratch, "run_log")
    with runlog.run_logged(spark, path, "tps_ingest", "test") as ctx:
        ctx["row_count"] = 3
    with pytest.raises(ValueError):
        with runlog.run_logged(spark, path, "weather_cache"):
            raise ValueError("boom")
    state = {r.pipeline_name: r for r in runlog.run_state(
        spark.read.schema(runlog.RECORDS).parquet(path)).collect()}
    assert state["tps_ingest"].status == "success" and state["tps_ingest"].row_count == 3
    assert state["tps_ingest"].triggered_by == "test"
    assert state["weather_cache"].status == "failure" and state["weather_cache"].error_message == "boom"
    assert runlog.latest_runs(runlog.run_state(spark.read.schema(runlog.RECORDS).parquet(path))).count() == 2


def test_stream_equals_batch_with_overlapping_days(spark, scratch):
    root = os.path.join(scratch, "landed")
    fx = incident_fixture()
    land_json(root, "year=2024/month=01/day=18", fx)
    # a later day re-delivers T-91 with a new hour; a third day adds T-8
    day2 = {"features": [dict(fx["features"][1], attributes=dict(fx["features"][1]["attributes"], OCC_HOUR="20"))]}
    land_json(root, "year=2024/month=01/day=19", day2)
    day3 = {"features": [dict(fx["features"][0], attributes=dict(fx["features"][0]["attributes"],
                                                                 EVENT_UNIQUE_ID="T-8"))]}
    land_json(root, "year=2024/month=01/day=20", day3)
    table = os.path.join(scratch, "stream_table")
    q = stream_ingest.start_incident_stream(spark, root, table, os.path.join(scratch, "ckpt"))
    q.awaitTermination()
    streamed = {r.event_id: r.occ_date_utc for r in stream_ingest.read_table(spark, table).collect()}
    batch = {r.event_id: r.occ_date_utc for r in upsert.merge_last_wins(
        None, ingest.normalise_incidents(landed.read_incident_documents(spark, root)), ["event_id"],
        list(ingest.ORDER_COLUMNS), ("inserted_at",), _raw_schema_cols()).collect()}
    assert streamed == batch
    assert len(streamed) == 4 and streamed["T-91"] == datetime(2024, 1, 19, 1)


def test_key_checks_count_nulls_and_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",), ("c",), ("c",)], "k string")
    got = {r.check: (r.failures, r.passed) for r in quality.key_checks(df, "m", ["k"]).collect()}
    assert got == {"not_null": (2, False), "unique": (2, False)}
    ok = {r.check: r.passed for r in quality.key_checks(df.filter("k = 'b'"), "m", ["k"]).collect()}
    assert ok == {"not_null": True, "unique": True}


def test_csv_roundtrip_quotes_commas_and_newlines(spark, scratch):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("name", T.StringType()),
                           T.StructField("flag", T.BooleanType()), T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("T-704", 'Yonge, "St." Clair', True, None),
                                ("T-91", "line one\nline two", None, 3)], schema)
    out = os.path.join(scratch, "csv")
    export.write_csv(df, out)
    back = export.read_csv(spark, out, schema)
    # multi-line fields need the multiLine reader option
    back_ml = export.read_csv(spark, out, schema, multiline=True)
    assert sorted(map(tuple, back_ml.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    assert back.filter("event_id = 'T-704'").first().name == 'Yonge, "St." Clair'


def test_day_at_the_source_page_limit_is_flagged(spark):
    from squall.plans import requests as rq
    feats = spark.range(1000).select(F.lit("2024-01-01").cast("date").alias("doc_day"))
    plan = rq.incident_days(rq.resolve_start(spark, "2024-01-01"), "2024-01-02")
    got = {r.local_day.day: (r.n_landed, r.possibly_truncated)
           for r in rq.incident_days_with_landed(plan, feats).collect()}
    assert got == {1: (1000, True), 2: (0, False)}


def test_force_mode_rounds_like_the_joiner(spark):
    # one rounding rule on both sides (decimal, half away from zero): 43.605 -> 43.61,
    # the grid value the incident side computes for the same coordinate
    from squall.plans import requests as rq
    r = rq.weather_force(spark, 43.605, -79.385, "2024-01-01").first()
    assert (float(r.lat_r), float(r.lon_r)) == (43.61, -79.39)
    assert "latitude=43.61&longitude=-79.39" in r.url
