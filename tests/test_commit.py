"""The day as the unit of commit, dead letters, key constraints, and landings that are loaded once."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import incident_fixture, land_json, weather_fixture
from squall.operators import commit, runlog, upsert
from squall.plans import datasets, runs
from squall.schemas import WEATHER_CACHE
from squall.sources import adapters, landed, tables
from squall.streaming import ingest as stream_ingest


def _day(number, hour=None):
    """The fixture's three incidents under ids of that day; ``hour`` for the second."""
    doc = json.loads(json.dumps(incident_fixture()))
    for f in doc["features"]:
        f["attributes"]["EVENT_UNIQUE_ID"] += f"-{number}"
    if hour is not None:
        doc["features"][1]["attributes"]["OCC_HOUR"] = hour
    return doc


def _land(root, number, hour=None):
    return land_json(root, f"year=2024/month=01/day={number}", _day(number, hour))


def _ids(spark, raw):
    return {r.event_id for r in tables.read_raw_incidents(spark, raw).collect()}


@pytest.mark.parametrize("key,value", [("OCC_HOUR", "xx"), ("OCC_HOUR", "24"), ("OBJECTID", "many"), ("OCC_DATE", "soon"), ("LAT_WGS84", "north"), ("LONG_WGS84", 12345678)])
def test_a_bad_value_fails_its_day_and_no_other(spark, scratch, key, value):
    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    for number in (18, 20):
        _land(root, number)
    bad = _day(19)
    bad["features"][1]["attributes"][key] = value
    land_json(root, "year=2024/month=01/day=19", bad)
    with pytest.raises(runs.FailedDays, match="2024-01-19"):
        runs.ingest_incidents(spark, root, raw, log)
    assert len(_ids(spark, raw)) == 6 and not any(i.endswith("-19") for i in _ids(spark, raw))
    days = {str(r.doc_day): (r.status, r.n_rows, r.n_bad, r.reason) for r in commit.read_days(spark, raw).collect()}
    assert days == {"2024-01-18": ("stored", 3, 0, None), "2024-01-19": ("failed", 3, 1, key), "2024-01-20": ("stored", 3, 0, None)}
    state = tables.read_run_log(spark, log).first()
    assert (state.status, state.row_count) == ("failure", 6) and key in state.error_message
    dead = commit.read_dead_letters(spark, raw).collect()
    assert [(r.event_id, r.reason) for r in dead] == [("T-91-19", key)] and json.loads(dead[0].raw)["attributes"]["EVENT_UNIQUE_ID"] == "T-91-19"


def test_failed_days_are_read_again_by_the_next_incremental_run(spark, scratch):
    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    for number in (18, 19, 20):
        _land(root, number, "xx" if number == 19 else None)
    assert runs.ingest_incidents(spark, root, raw, log, on_failed_day="log").first().rows_upserted == 6
    state = tables.read_run_log(spark, log).first()
    assert state.status == "success" and "2024-01-19" in state.error_message
    assert [str(d) for d in commit.open_days(spark, raw)] == ["2024-01-19"]
    _land(root, 19)
    again = runs.ingest_incidents(spark, root, raw, log, incremental=True).first()
    assert again.rows_upserted >= 3 and len(_ids(spark, raw)) == 9 and commit.open_days(spark, raw) == []


def test_lenient_ingest_stores_the_day(spark, scratch):
    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    _land(root, 18, "xx")
    assert runs.ingest_incidents(spark, root, raw, log, lenient=True).first().rows_upserted == 3
    assert {r.status for r in commit.read_days(spark, raw).collect()} == {"stored"}


def test_a_failing_upsert_leaves_no_staging(spark, scratch):
    cache = os.path.join(scratch, "cache")
    hours = landed.weather_hours_from_documents(landed.read_weather_documents(spark, land_json(scratch, "wx/lat=43.72/lon=-79.41", weather_fixture(), "w.json")))
    rows = hours.withColumn("doc", F.lit(0)).withColumn("lat", F.when(F.hour("hour_utc") != 5, F.col("lat")))
    with pytest.raises(Exception, match="NULL in key column lat"):
        upsert.upsert_table(spark, cache, rows, WEATHER_CACHE, ["lat", "lon", "hour_utc"], ["doc"], tables.WEATHER_PARTITIONING)
    assert tables.read_weather_cache(spark, cache).count() == 0
    assert not os.path.exists(f"{cache}.staging") or os.listdir(f"{cache}.staging") == []
    counts = upsert.upsert_table(spark, cache, rows, WEATHER_CACHE, ["lat", "lon", "hour_utc"], ["doc"], tables.WEATHER_PARTITIONING, null_keys="drop").first()
    assert tuple(counts) == (23, 23, 1) and tables.read_weather_cache(spark, cache).count() == 23


def test_a_weather_document_without_a_point_is_rejected(spark, scratch):
    root, cache, log = (os.path.join(scratch, n) for n in ("wx", "cache", "log"))
    land_json(root, "lat=43.72/lon=-79.41", weather_fixture(), "w.json")
    land_json(root, "lost", weather_fixture(), "w.json")
    with pytest.raises(runs.RejectedDocuments, match="no grid point"):
        runs.backfill_weather(spark, root, cache, log, strict=True)
    assert not os.path.exists(cache)
    assert runs.backfill_weather(spark, root, cache, log).first().rows_upserted == 24
    state = {r.status: (r.row_count, r.error_message) for r in tables.read_run_log(spark, log).collect()}
    assert state["success"] == (24, "rejected documents: 1 no grid point") and state["failure"][0] == 0


def _stream(spark, root):
    stream_ingest.start_incident_stream(spark, f"{root}/landed", f"{root}/raw", f"{root}/checkpoint", files_per_trigger=1,
                                        run_log_path=f"{root}/log").awaitTermination()


def test_stream_rejects_are_told_once_after_a_replay(spark, scratch):
    _land(f"{scratch}/landed", 18)
    with open(f"{scratch}/landed/year=2024/month=01/day=18/cut.json", "w") as f:
        f.write(json.dumps(_day(18))[:150] + "\n")
    _land(f"{scratch}/landed", 19, "xx")
    _stream(spark, scratch)

    def told():
        return sorted((str(r.doc_day), r.reason, r.event_id) for r in commit.read_dead_letters(spark, f"{scratch}/raw").collect())

    want = [("2024-01-18", "unparsable", None), ("2024-01-19", "OCC_HOUR", "T-91-19")]
    assert told() == want and len(_ids(spark, f"{scratch}/raw")) == 3
    commits = sorted((n for n in os.listdir(f"{scratch}/checkpoint/commits") if n.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{scratch}/checkpoint/commits/{name}")        # as if the driver had died before the last commit
    _stream(spark, scratch)
    assert told() == want and len(_ids(spark, f"{scratch}/raw")) == 3
    state = tables.read_run_log(spark, f"{scratch}/log").collect()
    assert len(state) == len(commits) + 1 and all(r.status == "success" and r.pipeline_name == "tps_stream" for r in state)
    assert {r.triggered_by for r in state} == {f"stream-{int(n):09d}" for n in commits}


def test_a_new_landing_is_all_that_a_second_backfill_reads(spark, scratch, monkeypatch):
    sf = "/root/testdata/sf0.001"
    root, cache, log = (os.path.join(scratch, n) for n in ("wx", "cache", "log"))
    hours = datasets.weather_cache(spark, sf)
    landed.land_weather_documents(hours, root, load=5)
    first = runs.backfill_weather(spark, root, cache, log, incremental=True).first()
    assert first.rows_upserted == hours.count()
    files = [n for n in os.listdir(f"{root}/load=5") if n.startswith("part-")]
    assert len(files) <= 8                                       # by bytes: 8 shuffle partitions, many points and days
    landed.land_weather_documents(hours.limit(1), root, load=3)             # a lower number, finished later
    os.makedirs(f"{root}/load=9")                                # not finished
    read = []
    inner = landed.parsed_weather_documents
    monkeypatch.setattr(landed, "parsed_weather_documents", lambda *a, **k: read.append(inner(*a, **k)) or read[-1])
    assert runs.backfill_weather(spark, root, cache, log, incremental=True).first().rows_upserted == 1
    assert len(read) == 1 and all("/load=3/" in f for f in read[0].inputFiles()) and len(read[0].inputFiles()) >= 1
    assert runs.backfill_weather(spark, root, cache, log, incremental=True).first().rows_upserted == 0 and len(read) == 1


def test_documents_are_parsed_once_for_each_ingest(spark, scratch, monkeypatch):
    """What is counted and what is stored comes from one evaluation of the landed text."""
    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    _land(root, 18)
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        calls.add(1)
        return value

    inner = landed.read_landed_text
    monkeypatch.setattr(landed, "read_landed_text", lambda *a, **k: inner(*a, **k).withColumn("value", seen.asNondeterministic()("value")))
    runs.ingest_incidents(spark, root, raw, log)
    assert calls.value == 1 and len(_ids(spark, raw)) == 3


def test_inserted_at_of_the_first_ingest_stays(spark, scratch):
    root, raw, log = (os.path.join(scratch, n) for n in ("landed", "raw", "log"))
    _land(root, 18)
    runs.ingest_incidents(spark, root, raw, log)
    first = {r.event_id: r.inserted_at for r in tables.read_raw_incidents(spark, raw).collect()}
    _land(root, 18)
    runs.ingest_incidents(spark, root, raw, log)
    assert {r.event_id: r.inserted_at for r in tables.read_raw_incidents(spark, raw).collect()} == first and None not in first.values()


def test_a_failed_run_keeps_its_row_count(spark, scratch):
    with pytest.raises(RuntimeError), runlog.run_logged(spark, f"{scratch}/log", "p") as ctx:
        ctx["row_count"] = 4
        raise RuntimeError("late")
    assert tables.read_run_log(spark, f"{scratch}/log").first().row_count == 4


def test_a_landed_day_is_one_file_whatever_the_tasks(spark, scratch):
    """Files follow the bytes, so a stream of so many files a batch needs no batch for each writing task."""
    events = (spark.range(24000).withColumn("ts", F.timestamp_seconds(1704067200 + F.pmod(F.xxhash64("id"), F.lit(5 * 86400))).cast("timestamp_ntz"))
              .select(F.col("id").alias("event_id"), "ts", (F.col("id") % 50).alias("user_id"), F.lit("click").alias("event_type"), F.lit(1.0).alias("value")))
    landed.land_incident_documents(adapters.incident_features(events.repartition(8)), scratch, load=1)
    files = [f for _, _, names in os.walk(scratch) for f in names if f.startswith("part-")]
    assert len(files) == 5
    assert landed.read_incident_documents(spark, scratch).count() == 24000
