"""Exact deduplication over an extendible-hash index on shared files.

Index entries are the distinct 64-bit keys of the texts. A directory maps the first bits of
a key to a bucket: starting from one bucket, an overfull bucket is split by its next bit, and
the directory doubles when a bucket already uses all its bits. Entries lie in Parquet files
sorted by bucket and key, so an owner task holds a range of buckets; copies of a text fold
into one entry before anything is shuffled, so no text, however often it is repeated, makes
a bucket overfull. Texts under one key are compared byte by byte with the head of the
key's chain (the largest doc_id); those that differ (a key collision) go to the next link of
the chain, until none is left.

Defined results: null text is empty text; nothing else is normalised. Rows without doc_id
never stand for a group that has a doc_id; in a group without any, keep_id is null and all
are kept. Rows that repeat a doc_id and text are all kept or all dropped with it. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm import common
from squall.session import scratch_path

CAPACITY = 100_000       # keys in a bucket
MAX_DIRECTORY = 1 << 20  # directory slots that are broadcast; 100 billion keys need them
KEY_BITS = 64
HOT = 1000               # members of a key that are compared with its head by one task, about


def prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, KEY_BITS - bits).cast("long") if bits else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Slots (slot, bucket, local depth, global depth) for the distinct ``key`` values."""
    n = keys.count()
    bits = min(KEY_BITS, max(0, math.ceil(math.log2(max(1, n / capacity)))) + 2)
    while True:
        held = {r[0]: r[1] for r in keys.groupBy(prefix(F.col("key"), bits).alias("p")).count().collect()}
        buckets, todo = [], [(0, 0)]
        overfull = False
        sums = [held]
        for _ in range(bits):
            up: dict[int, int] = {}
            for p, c in sums[-1].items():
                up[p >> 1] = up.get(p >> 1, 0) + c
            sums.append(up)
        while todo:
            p, depth = todo.pop()
            size = sums[bits - depth].get(p, 0)
            if size <= capacity or depth == bits:
                overfull |= size > capacity
                buckets.append((p, depth))
            else:
                todo += [(2 * p, depth + 1), (2 * p + 1, depth + 1)]
        if not overfull or bits == KEY_BITS or 2 ** (bits + 1) > MAX_DIRECTORY:
            break
        bits += 1
    deepest = max(d for _, d in buckets)
    slots = []
    for number, (p, depth) in enumerate(sorted(buckets, key=lambda b: b[0] << (deepest - b[1]))):
        free = deepest - depth
        slots += [((p << free) + i, number, depth, deepest) for i in range(1 << free)]
    return slots


def build_index(entries: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """Write (key, head, c) entries under their buckets: the index and its directory, read back."""
    spark = entries.sparkSession
    slots = directory(entries.select("key"), capacity)
    folder = scratch_path(spark, "extendible-hash")
    table = spark.createDataFrame(slots, "slot long, bucket int, local_depth int, global_depth int").coalesce(1)
    table.write.parquet(f"{folder}/directory")
    placed = (entries.withColumn("slot", prefix(F.col("key"), slots[0][3])).join(F.broadcast(table.select("slot", "bucket")), "slot").drop("slot"))
    order = ["bucket", F.shiftrightunsigned("key", 32), "key"]
    placed.repartitionByRange(*order).sortWithinPartitions("bucket", "key").write.parquet(f"{folder}/buckets")
    return spark.read.schema(placed.schema).parquet(f"{folder}/buckets"), spark.read.schema(table.schema).parquet(f"{folder}/directory")


class Probe:
    """Looks keys up as the index stores them: a key's first bits are a slot of the directory, the slot names the bucket."""

    def __init__(self, table: DataFrame):
        self.depth = table.agg(F.max("global_depth")).first()[0]
        self.slots = table.select("slot", "bucket")

    def buckets(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("slot", prefix(F.col("key"), self.depth)).join(F.broadcast(self.slots), "slot").drop("slot")


def duplicates(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = KEY_BITS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    ``key_bits`` below 64 forces key collisions (for tests); results do not depend on it.
    """
    text = common.text_or_empty()
    key = F.xxhash64(text).bitwiseAND(F.lit(-1 << (64 - key_bits)))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("n"))
    rows = common.stored(docs.select("doc_id", key.alias("key"), F.sha2("text", 256).alias("sha")), "exact-rows")
    left = rows.select("key", "sha", "doc_id")
    found = []
    for link in count():
        heads = common.stored(left.groupBy("key").agg(F.max("doc_id").alias("head"), F.count("*").alias("c")), "exact-heads")
        index, table = build_index(heads, capacity)
        probe = Probe(table)
        if link == 0:
            alone = probe.buckets(rows).join(index.where("c = 1").select("bucket", "key"), ["bucket", "key"])
            found.append(alone.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha"))
        # Of a key with many members each part, with its own copy of the head's text, is a task's share.
        part = F.ceil(F.col("c") / HOT).cast("long").alias("parts")
        repeated = index.where("c > 1" if link == 0 else "true").select("bucket", "key", "head", part)
        texts = docs.withColumn("key", key)
        if link:
            texts = (texts.withColumn("sha", F.sha2("text", 256))
                     .join(left.select("key", "sha").distinct(), ["key", "sha"], "left_semi").drop("sha"))
        members = probe.buckets(texts).join(repeated.hint("merge"), ["bucket", "key"]).withColumn("part", F.pmod("n", "parts"))
        chained = (members.where(F.col("doc_id").eqNullSafe(F.col("head"))).groupBy("bucket", "key", "parts").agg(F.min("text").alias("head_text"))
                   .select("bucket", "key", "head_text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
        compared = common.stored(members.join(chained.hint("merge"), ["bucket", "key", "part"]).select("key", "doc_id", "head", (F.col("text") == F.col("head_text")).alias("same"),
                                                                     F.sha2("text", 256).alias("sha")), "exact-compared")
        same = compared.where("same")
        sizes = same.groupBy("key").agg(F.count("*").alias("group_size"))
        found.append(same.join(sizes, "key").select("doc_id", F.col("head").alias("keep_id"), "group_size", "sha"))
        left = compared.where("not same").select("key", "sha", "doc_id")
        if left.isEmpty():
            break
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    kept = F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull())
    return out.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"))
