"""The merge of stored files by winners first: the same rows as the one-pass merge, and no sort of the payload."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators import upsert

SCHEMA = (T.StructType().add("k", T.StringType()).add("v", T.IntegerType()).add("raw", T.VariantType())
          .add("ins", T.IntegerType()).add("pos", T.IntegerType()).add("p", T.StringType()))
COLS = SCHEMA.names


def _files(spark, path, rows):
    """Rows (k, v, pos, p) in Parquet files; ``ins`` is the value times ten."""
    df = spark.createDataFrame(rows, "k string, v int, pos int, p string").repartition(3)
    df.select("k", "v", F.parse_json(F.concat(F.lit('{"v": '), "v", F.lit("}"))).alias("raw"), (F.col("v") * 10).alias("ins"), "pos", "p").write.partitionBy("p").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def _rows(df):
    return sorted(map(tuple, df.withColumn("raw", F.to_json("raw")).collect()), key=str)


def test_winners_first_equals_one_pass(spark, scratch):
    stored = _files(spark, os.path.join(scratch, "s"), [(f"k{i}", i, i, "ab"[i % 2]) for i in range(20)])
    batch = _files(spark, os.path.join(scratch, "b"), [("k3", 100 + i, 50 + i, "b") for i in range(40)]       # a hot key
                   + [("k5", 7, 2, "a"), ("new", 1, 1, "c"), (None, 9, 9, "a"), ("k9", 55, 9, "b")])      # older, new, NULL, tie
    for in_target in (True, False):
        args = (stored.where("p <> 'z'"), batch, ["k"], ["pos"], ("ins",), COLS, in_target)
        assert _rows(upsert.merge_files(*args)) == _rows(upsert.merge_last_wins(*args))
    got = {r.k: (r.v, r.ins) for r in upsert.merge_files(stored, batch, ["k"], ["pos"], ("ins",), COLS, True).collect()}
    assert got["k3"] == (139, 30) and got["k5"] == (5, 70) and got["k9"] == (55, 90) and got["new"] == (1, 10) and None not in got
    with pytest.raises(Exception, match="key column k"):
        upsert.merge_files(stored, batch, ["k"], ["pos"], (), COLS, True, "error").collect()
    none = batch.where("false")
    assert _rows(upsert.merge_files(stored, none, ["k"], ["pos"], (), COLS)) == _rows(stored)
    assert upsert.merge_files(stored.where("false"), none, ["k"], ["pos"], (), COLS).count() == 0


def test_the_payload_is_not_sorted(spark, scratch):
    stored = _files(spark, os.path.join(scratch, "s"), [("a", 1, 1, "x")])
    merged = upsert.merge_files(stored, stored, ["k"], ["pos"], (), COLS)
    plan = merged._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert all("raw" not in line for line in plan.splitlines() if "SortAggregate" in line or "Sort [" in line)


def test_a_table_merged_winners_first(spark, scratch):
    batch = _files(spark, os.path.join(scratch, "b"), [(f"k{i % 4}", i, i, "xy"[i % 2]) for i in range(9)])
    state = []
    for first in (True, False):
        table = os.path.join(scratch, f"t{first}")
        for some in (batch.where("v < 5"), batch.where("v >= 5")):
            upsert.upsert_table(spark, table, some, SCHEMA, ["k"], ["pos"], ["p"], ("ins",), True, False, staged=True, winners_first=first)
        state.append(_rows(spark.read.schema(SCHEMA).parquet(table)))
    assert state[0] == state[1] and len(state[0]) == 4
