"""One ordered CSV file written by many tasks: the bytes of the single-task export."""

import glob
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from squall.operators import export, onefile


def single(df, order, folder):
    """The bytes that one task writes for the sorted rows."""
    text = onefile.sorted_text(df, order, ("occ_date_day",))
    export.csv_writer(text.coalesce(1)).option("header", True).csv(folder)
    return open(glob.glob(f"{folder}/part-*.csv")[0], "rb").read()


def rows(spark, n=5000):
    text = F.expr("array('plain', 'a,b', 'say \"so\"', 'two\\nlines', ' lead', '', null, 'Größe 🙂', '#x')[cast(id % 9 as int)]")
    return (spark.range(n, numPartitions=7).withColumn("event_id", F.concat(F.lit("T-"), F.pmod(F.xxhash64("id"), F.lit(n // 3))))
            .withColumn("event_id", F.when(F.col("id") % 11 != 0, F.col("event_id")))
            .withColumn("name, with comma", text)
            .withColumn("flag", F.expr("case id % 3 when 0 then true when 1 then false end"))
            .withColumn("at", F.timestamp_seconds(F.col("id") * 1000)).withColumn("x", (F.col("id") / 7).cast("float")))


def test_bytes_equal_those_of_one_task(spark, scratch):
    df = rows(spark)
    want = single(df, ["event_id", "at"], f"{scratch}/single")
    for piece, turn in ((1000, df), (64 << 20, df.repartition(13, "x"))):
        n = onefile.write_csv_file(turn, f"{scratch}/out/incidents.csv", ["event_id", "at"], piece=piece)
        got = open(f"{scratch}/out/incidents.csv", "rb").read()
        assert len(got) == n and got == want
    assert os.listdir(f"{scratch}/out") == ["incidents.csv"]          # parts and unfinished files are gone


def test_equal_rows_and_a_hot_key_keep_the_bytes(spark, scratch):
    df = rows(spark, 900).withColumn("event_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("event_id"))).drop("id", "at", "x")
    df = df.unionByName(df)
    want = single(df, ["event_id"], f"{scratch}/single")
    onefile.write_csv_file(df.repartition(5), f"{scratch}/one.csv", ["event_id"])
    assert open(f"{scratch}/one.csv", "rb").read() == want
    onefile.write_csv_file(df.repartition(3), f"{scratch}/one.csv")
    assert open(f"{scratch}/one.csv", "rb").read() == single(df, [], f"{scratch}/text")


def test_read_back_order_and_names(spark, scratch):
    df = spark.createDataFrame([(2, "b", datetime(2024, 1, 2, tzinfo=timezone.utc)), (None, "n", None), (1, "a\nb", None), (10, None, None)],
                               "`by` int, `line` string, `at` timestamp")
    onefile.write_csv_file(df, f"{scratch}/x.csv", ["by"])
    back = export.read_csv(spark, f"{scratch}/x.csv", df.schema).collect()
    assert [r["by"] for r in back] == [None, 1, 2, 10] and back[1]["line"] == "a\nb"


def test_no_rows_give_the_header(spark, scratch):
    df = rows(spark, 30).where("false")
    n = onefile.write_csv_file(df, f"{scratch}/none.csv", ["event_id"])
    assert open(f"{scratch}/none.csv").read() == 'id,event_id,"name, with comma",flag,at,x\n' and n > 0


def test_a_failed_write_leaves_the_old_file(spark, scratch):
    path = f"{scratch}/old.csv"
    onefile.write_csv_file(rows(spark, 50), path, ["id"])
    old = open(path, "rb").read()
    with pytest.raises(Exception):
        onefile.write_csv_file(rows(spark, 50).withColumn("x", F.raise_error(F.lit("no")).cast("float")), path, ["id"])
    assert open(path, "rb").read() == old and os.listdir(scratch) == ["old.csv"]


def test_a_store_without_offsets_is_refused(spark):
    with pytest.raises(Exception):
        onefile.write_csv_file(spark.range(1), "memory://nowhere/x.csv", ["id"])


def test_one_file_is_read_by_many_tasks(spark, scratch):
    """Every record once, whatever the pieces cut: quoted line breaks, doubled quotes, records longer than a piece."""
    df = rows(spark, 700).withColumn("long", F.when(F.col("id") % 50 == 0, F.repeat(F.lit('a "b"\n, c\n'), 300)))
    path = f"{scratch}/many.csv"
    size = onefile.write_csv_file(df, path, ["event_id"])
    want = sorted(export.read_csv(spark, path, df.schema).collect(), key=lambda r: r["id"])
    assert len(want) == 700
    for piece in (97, 5000, size, 64 << 20):
        back = onefile.read_csv_file(spark, path, df.schema, piece=piece)
        assert sorted(back.collect(), key=lambda r: r["id"]) == want
    parts = [r[0] for r in onefile.read_csv_file(spark, path, df.schema, piece=5000).select(F.spark_partition_id()).distinct().collect()]
    assert len(parts) > 8


def test_pieces_are_copied_by_many_tasks(spark, scratch, monkeypatch):
    copier = onefile._copier

    def seen(target):
        inner = copier(target)
        return lambda frames: inner(tasks_of(frames, f"{scratch}/tasks"))

    def tasks_of(frames, folder):
        os.makedirs(folder, exist_ok=True)
        for frame in frames:
            if len(frame):
                from pyspark import TaskContext
                open(f"{folder}/{TaskContext.get().partitionId()}", "w").close()
            yield frame

    monkeypatch.setattr(onefile, "_copier", seen)
    size = onefile.write_csv_file(rows(spark, 3000), f"{scratch}/x.csv", ["event_id"], piece=8000)
    assert os.path.getsize(f"{scratch}/x.csv") == size and len(os.listdir(f"{scratch}/tasks")) > 8
