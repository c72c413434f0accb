import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from squall.llm import exthash


def brute(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        out += [(d, keep, len(ids), keep is None or d == keep, hashlib.sha256(t.encode()).hexdigest()) for d in ids]
    return sorted(out, key=str)


g = random.Random(8)
ROWS = ([(i, g.choice(["", "a", "A", "long " * 5000])) for i in range(30)] + [(100, "own")]
        + [(200, None), (201, None), (None, "a"), (None, "no id"), (None, "no id"), (30, "a"), (30, "a"), (30, "other text")])


@pytest.mark.parametrize("bits,capacity", [(64, 1), (1, 100)])
def test_matches_brute_force_also_with_collisions(spark, documents, bits, capacity):
    got = exthash.duplicates(documents(ROWS), capacity, bits).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)


def test_empty_table(spark, documents):
    assert exthash.duplicates(documents(ROWS).where("false")).count() == 0


def test_directory_doubles_and_splits_overfull_buckets(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    slots = exthash.directory(keys, 100)
    depth = slots[0][3]
    assert [s[0] for s in sorted(slots)] == list(range(2 ** depth))
    held = defaultdict(int)
    bucket = {s[0]: s[1] for s in slots}
    for r in keys.select(exthash.prefix(F.col("key"), depth).alias("p")).collect():
        held[bucket[r["p"]]] += 1
    assert max(held.values()) <= 100 and len(held) > 50
    local = {s[1]: s[2] for s in slots}
    assert all(sum(1 for s in slots if s[1] == b) == 2 ** (depth - d) for b, d in local.items())


def test_index_files_are_in_bucket_and_key_order(spark):
    entries = spark.range(3000).select(F.xxhash64("id").alias("key"), F.col("id").alias("head"), F.lit(1).cast("long").alias("c"))
    index, directory = exthash.build_index(entries, 200)
    assert index.count() == 3000 and directory.select("bucket").distinct().count() > 10
    files = index.groupBy(F.input_file_name().alias("f")).agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))
