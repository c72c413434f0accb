import hashlib

import pytest
import xxhash
from pyspark.sql import functions as F

from squall.llm import common, feistel, shards


def _plain_once(x, a, b, seed, portable):
    left, right = x % a, x // a
    for turn in range(feistel.ROUNDS):
        if portable:
            bits = int(hashlib.md5(f"{seed}:{turn}:{right}".encode()).hexdigest()[:12], 16)
        else:
            bits = xxhash.xxh64_intdigest(seed.encode(), 42)
            for value, width in ((turn, 4), (right, 8)):
                bits = xxhash.xxh64_intdigest(value.to_bytes(width, "little"), bits)
            bits &= (1 << 48) - 1
        side = a if turn % 2 == 0 else b
        left, right = right, (left + bits % side) % side
    return a * right + left


# 2210 and 2211 rows, like 0 and 21, have cycles wholly out of range.
@pytest.mark.parametrize("portable", [True, False])
def test_every_small_n_ends_and_equals_the_plain_walk(spark, portable):
    sizes = [*range(301), 485, 832, 2210, 2211]
    dims = spark.createDataFrame([(n, *feistel.sides(n)) for n in sizes], "n long, a long, b long")
    depth = feistel.longest_walk(dims.where("a * b > n").select("*", F.explode(F.expr("sequence(n, a * b - 1)")).alias("x")), "shard", portable)
    rows = dims.where("n > 0").select("*", F.explode(F.expr("sequence(0L, n - 1)")).alias("x"))
    got = {}
    for r in rows.withColumn("y", feistel.permuted(*(F.col(c) for c in "xnab"), "shard", depth, portable)).collect():
        got.setdefault(r["n"], {})[r["x"]] = r["y"]
    for n in sizes[1:]:
        a, b = feistel.sides(n)
        assert sorted(got[n].values()) == list(range(n)), n
        for x, y in got[n].items():
            want = _plain_once(x, a, b, "shard", portable)
            while want >= n:
                want = _plain_once(want, a, b, "shard", portable)
            assert y == want


def test_permutation_is_a_bijection_for_every_small_n(spark):
    for n in (1, 2, 3, 7, 16, 17, 21, 101, 1000):
        got = [r[0] for r in feistel.shuffled(spark.range(n), "id", "p", n, "s").select("p").collect()]
        assert sorted(got) == list(range(n)), n
    assert got != list(range(1000))


def test_seeds_differ(spark):
    a, b = ([r[0] for r in feistel.shuffled(spark.range(50), "id", "p", 50, s).orderBy("id").select("p").collect()] for s in "ab")
    assert a != b


def test_shards_are_even_gapless_and_reproducible(spark, documents):
    rows = [(i, f"text {i % 7}") for i in range(101)] + [(None, None), (None, "x"), (5, "other"), (5, "other")]
    docs = documents(rows)
    got = shards.digest(docs).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert set(by) <= set(range(8)) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = shards.digest(docs.repartition(7, "text")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    null = [r for r in got if r["size"] == 1]
    assert len(null) == 1 and null[0]["text_crc32"] == 0


def test_whole_rows_keep_their_columns(spark, documents):
    docs = documents([(i, f"t{i}") for i in range(20)]).withColumn("shard", F.lit("clash"))
    out = shards.shuffle(docs)
    assert sorted(out.columns) == sorted([*docs.columns, "slot"]) and out.count() == 20
    assert dict(out.dtypes)["shard"] == "int"
    assert shards.shuffle(docs.where("false")).count() == 0


def test_numbering_is_the_global_rank(spark):
    df = spark.range(1000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(50))).repartition(6)
    rows, n = common.numbered(df, [F.col("k"), F.col("id")], "t")
    got = [(r["k"], r["id"]) for r in rows.orderBy("row_number").collect()]
    assert n == 1000 and got == sorted(got)


def test_components_match_union_find(spark):
    import random

    g = random.Random(5)
    edges = [(g.randrange(300), g.randrange(300)) for _ in range(170)] + [(400 + i, 401 + i) for i in range(30)] + [(7, i) for i in range(600, 700)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    want = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    got = {r["node"]: r["component"] for r in common.components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert got == want
    assert common.components(spark.createDataFrame([(3, 3)], "u long, v long"), "t").count() == 0
