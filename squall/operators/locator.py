"""Where the keys of a partitioned table are: key -> partition value, without scanning the table.

An upsert must rewrite the partitions that its keys live in now, and an update can move a row to
another partition. The index is a narrow table beside the data, ``<table>.keys``: (key columns,
partition value), dealt over ``BUCKETS`` folders by a hash of the key. A batch reads only the
buckets that its keys fall in, so a small batch opens few files, however many partitions the
table has; no file of the table itself is opened to find a key.

Entries are only added, and before the table changes: an entry that is out of date costs a partition
read in vain, a missing one would cost a duplicate key, and there is none at any moment. After
``REBUILD_AFTER`` additions the next upsert builds the index anew from the table's key columns, which
also drops what is out of date. A build is a folder with a number of its own, complete when its
``_SUCCESS`` mark is there; the highest complete one counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.session import fs_path

BUCKETS = 256
REBUILD_AFTER = 64


def index_path(table: str) -> str:
    return f"{table.rstrip('/')}.keys"


class KeyIndex:
    """The index of the table at ``path`` with rows ``stored``; built from it if there is none or it is due."""

    def __init__(self, spark: SparkSession, path: str, stored: DataFrame, keys: list[str], partition: str):
        self.spark, self.root, self.keys, self.partition = spark, index_path(path), keys, partition
        fields = [T.StructField(c, stored.schema[c].dataType, True) for c in (*keys, partition)]
        self.schema = T.StructType([*fields, T.StructField("bucket", T.IntegerType(), True)])
        builds = self._builds()
        if not builds or self._added(builds[-1][1]) >= REBUILD_AFTER:
            self._build(stored, builds[-1][0] + 1 if builds else 1)
            for _, old in builds:
                fs, place = fs_path(spark, old)
                fs.delete(place, True)
            builds = self._builds()
        self.folder = builds[-1][1]

    def _builds(self) -> list[tuple[int, str]]:
        """Complete builds in order: (number, folder)."""
        fs, root = fs_path(self.spark, self.root)
        if not fs.exists(root):
            return []
        found = []
        for f in fs.listStatus(root):
            number = f.getPath().getName().removeprefix("build=")
            if number.isdigit() and fs.exists(fs_path(self.spark, f"{f.getPath().toString()}/_SUCCESS")[1]):
                found.append((int(number), f.getPath().toString()))
        return sorted(found)

    def _added(self, folder: str) -> int:
        fs, place = fs_path(self.spark, f"{folder}/_added")
        return len(fs.listStatus(place)) if fs.exists(place) else 0

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(BUCKETS)).cast("int").alias("bucket")

    def _build(self, stored: DataFrame, number: int) -> None:
        rows = stored.select(*self.keys, self.partition, self._bucket())
        # Large buckets are split by size, and sorted files let a key's range skip row groups.
        (rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.root}/build={number}"))

    def known(self, keys: DataFrame) -> DataFrame:
        """Entries (key, partition value) of the distinct ``keys``; only their buckets are read."""
        asked = keys.select(*self.keys, self._bucket())
        buckets = [r["bucket"] for r in asked.select("bucket").distinct().collect()]      # BUCKETS numbers at most
        entries = self.spark.read.schema(self.schema).parquet(self.folder).where(F.col("bucket").isin(buckets))
        return entries.join(asked, [*self.keys, "bucket"], "left_semi").select(*self.keys, self.partition).distinct()

    def add(self, entries: DataFrame, name: str) -> None:
        """Add entries (key, partition value)."""
        if entries.isEmpty():
            return
        (entries.select(*self.keys, self.partition, self._bucket()).repartition("bucket")
         .write.mode("append").partitionBy("bucket").parquet(self.folder))
        fs, mark = fs_path(self.spark, f"{self.folder}/_added/{name}")
        fs.create(mark).close()
