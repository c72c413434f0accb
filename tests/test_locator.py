"""The key index of upserts, and the run log's snapshots."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from squall.operators import locator, runlog, upsert
from squall.schemas import RAW_INCIDENTS
from squall.sources import tables
from squall.streaming.ingest import PARTITIONING, STREAM_TABLE


def _rows(spark, rows, landed_at):
    """(id, month, objectid) as normalised incidents; month None is undated."""
    data = [(i, o, None if m is None else dt.datetime(2024, m, 3), landed_at, n) for n, (i, m, o) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id string, objectid int, occ_date_utc timestamp, landed_at long, pos long")
    return df.select("event_id", "objectid", F.parse_json(F.lit("{}")).alias("raw"), "occ_date_utc", F.lit(None).cast("decimal(9,6)").alias("lat"),
                     F.lit(None).cast("decimal(9,6)").alias("lon"), F.lit(dt.datetime(2024, 1, 1)).alias("inserted_at"), F.lit(dt.date(2024, 1, 1)).alias("doc_day"),
                     F.lit(0).alias("page"), "pos", "landed_at", F.date_format("occ_date_utc", "yyyy-MM").alias("occ_month"))


def _upsert(spark, table, rows, landed_at):
    upsert.upsert_table(spark, table, _rows(spark, rows, landed_at), STREAM_TABLE, ["event_id"], ["landed_at", "doc_day", "page", "pos"], PARTITIONING,
                        preserve=("inserted_at",), order_in_target=True, partition_follows_key=False)


def _state(spark, table):
    rows = spark.read.schema(STREAM_TABLE).parquet(table).select("event_id", "occ_month", "objectid").collect()
    assert len({r.event_id for r in rows}) == len(rows)
    return {r.event_id: (r.occ_month, r.objectid) for r in rows}


def test_untouched_months_are_not_opened(spark, scratch):
    table = os.path.join(scratch, "raw")
    _upsert(spark, table, [(f"m{m}-{i}", m, 0) for m in range(1, 7) for i in range(5)], 1)
    for m in (3, 4, 5, 6):
        for f in glob.glob(f"{table}/occ_month=2024-0{m}/*.parquet"):
            os.chmod(f, 0o644)
            with open(f, "wb") as out:
                out.write(b"not a Parquet file")                  # opening one would fail
    _upsert(spark, table, [("m1-0", 1, 7), ("m2-1", 1, 8), ("new", 1, 9)], 2)
    got = spark.read.schema(STREAM_TABLE).parquet(f"{table}/occ_month=2024-01", f"{table}/occ_month=2024-02").select("event_id", "objectid").collect()
    got = {r.event_id: r.objectid for r in got}
    assert len(got) == 11 and (got["m1-0"], got["m2-1"], got["new"]) == (7, 8, 9)


def test_only_the_batch_s_buckets_are_read(spark, scratch):
    table = os.path.join(scratch, "raw")
    _upsert(spark, table, [(f"k{i}", 1 + i % 3, 0) for i in range(400)], 1)
    stored = spark.read.schema(STREAM_TABLE).parquet(table)
    index = locator.KeyIndex(spark, table, stored, ["event_id"], "occ_month")
    asked = spark.createDataFrame([("k5",), ("k77",), ("unknown",)], "event_id string")
    known = index.known(asked)
    assert sorted(tuple(r) for r in known.collect()) == [("k5", "2024-03"), ("k77", "2024-03")]
    opened = known.inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in glob.glob(f"{index.folder.removeprefix('file:')}/bucket=*/*.parquet")}) > 100
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("isnotnull(bucket", "bucket") and opened


def test_rows_that_move_stay_single_over_rebuilds(spark, scratch, monkeypatch):
    monkeypatch.setattr(locator, "REBUILD_AFTER", 2)
    table, want = os.path.join(scratch, "raw"), {}
    for n in range(6):
        batch = [(f"k{i}", [1, 2, None, 3][(i + n) % 4], n) for i in range(n % 2, 12, 2)] + [(f"only{n}", 2, n)]
        _upsert(spark, table, batch, n + 1)
        want |= {i: (None if m is None else f"2024-0{m}", o) for i, m, o in batch}
        assert _state(spark, table) == want
    builds = [d for d in os.listdir(f"{table}.keys") if d.startswith("build=")]
    assert len(builds) == 1 and builds[0] != "build=1"


def test_a_table_without_an_index_gets_one(spark, scratch):
    table = os.path.join(scratch, "raw")
    rows = _rows(spark, [("a", 1, 0), ("b", 2, 0)], 1)
    rows.select(*STREAM_TABLE.fieldNames()).write.partitionBy("occ_month").parquet(table)
    _upsert(spark, table, [("a", 2, 5)], 2)
    assert _state(spark, table) == {"a": ("2024-02", 5), "b": ("2024-02", 0)}
    assert set(tables.read_raw_incidents(spark, table).columns) == {f.name for f in RAW_INCIDENTS.fields}


def test_the_run_log_folds_into_a_snapshot(spark, scratch):
    log = os.path.join(scratch, "log")
    assert not runlog.compact(spark, log)
    for i in range(4):
        with runlog.run_logged(spark, log, f"p{i}", "test") as ctx:
            ctx["row_count"] = i
    with pytest.raises(RuntimeError), runlog.run_logged(spark, log, "bad"):
        raise RuntimeError("no")
    open_run = runlog.log_run_start(spark, log, "open")

    def state():
        return sorted(map(str, tables.read_run_log(spark, log).collect()))

    before = state()
    assert not runlog.compact(spark, log, after=50)
    files = len(glob.glob(f"{log}/part-*"))
    assert runlog.compact(spark, log, after=5) and state() == before
    assert len(glob.glob(f"{log}/part-*")) < files == 11
    runlog.log_run_end(spark, log, open_run, "success", 3)
    runlog.compact(spark, log, after=0)
    assert [r.row_count for r in tables.read_run_log(spark, log).where("pipeline_name = 'open'").collect()] == [3]
