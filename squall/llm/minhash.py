"""Near-duplicate classes of documents by min-max hashing.

A signature keeps, for every permutation, both the smallest and the largest permuted
shingle hash: two unbiased, barely correlated estimates for one evaluation. Bands of
signature values give bucket keys; a bucket's documents are candidates, and a candidate
pair is a link only if the full shingle sets confirm it
(100 * intersection >= 75 * union).

Documents with equal sets are one class before any pairing, so copies never make pairs.
Candidates are not expanded into all pairs of a bucket: every member is first compared
with its bucket's smallest document. Where a bucket then still holds several components,
the members outside its largest one meet all its members in blocks of bounded size, dealt
over tasks; a task counts the intersections of a block pair as a matrix product on the
full sets and returns links between different components only.

Defined results: a text without words (or null) has an empty set, size 0, and is linked
with nothing. Rows that share a doc_id are one node. A row without doc_id takes part in
nothing: component null, kept false. An empty table gives an empty result. Other columns
of the input are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm import common
from squall.llm.shingles import mix, shingle_set

WORDS = 5             # words in a shingle
PERMUTATIONS = 120    # hash evaluations; twice as many signature values
BAND_ROWS = 5         # signature values in a band
BLOCK = 512           # shingles permuted at once
BLOCK_DOCS = 256      # documents on each side of a block pair
COLUMNS = 1 << 14     # shingles counted at once in a block pair
SEED = 20240117


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    g = np.random.Generator(np.random.PCG64(SEED))
    a = g.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a[:, None], g.integers(0, 2**64 - 1, n, dtype=np.uint64)[:, None]


def signature(hashes: np.ndarray, permutations: int = PERMUTATIONS) -> np.ndarray:
    """Interleaved (min, max) of every permutation of a non-empty set of hashes."""
    a, b = _constants(permutations) if permutations != PERMUTATIONS else (_A, _B)
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for i in range(0, len(hashes), BLOCK):
        x = hashes[i:i + BLOCK] * a + b
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return np.stack([low, high], axis=1).ravel()


_A, _B = _constants(PERMUTATIONS)


def band_keys(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key for every band; the band's number is part of the key."""
    bands = sig[:len(sig) // rows * rows].reshape(-1, rows)
    odd = np.random.Generator(np.random.PCG64(SEED + 1)).integers(0, 2**62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return mix((mix(bands) * odd).sum(axis=1, dtype=np.uint64) + np.arange(1, len(bands) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                     ("bands", pa.list_(pa.int64()))])


def _sign(batches, k: int, permutations: int, rows: int):
    for batch in batches:
        sizes, keys, bands = [], [], []
        for text in batch.column(1):
            s = shingle_set(text.as_py(), k)
            sizes.append(len(s))
            keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            bands.append(band_keys(signature(s, permutations), rows).view(np.int64) if len(s) else None)
        yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                               pa.array(bands, pa.list_(pa.int64()))], schema=_SIGNED)


def _sets(batches, k: int):
    """(rep, set key, hashes) of each document."""
    for batch in batches:
        found = [shingle_set(t.as_py(), k).tobytes() for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array([xxhash.xxh3_128_digest(x) for x in found], pa.binary()), pa.array(found, pa.binary())],
                              names=["rep", "set_key", "hashes"])


def _hashes(value: pa.BinaryScalar) -> np.ndarray:
    """A stored set; no copy of it is made."""
    return np.frombuffer(value.as_buffer(), np.uint64)


def _confirm(batches, percent: int):
    """The pairs (u, v, set of u, set of v) that are links."""
    for batch in batches:
        u, v = [], []
        for a, b, x, y in zip(*batch.columns):
            p, q = _hashes(x), _hashes(y)
            if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                both = len(np.intersect1d(p, q, assume_unique=True))
                if 100 * both >= percent * (len(p) + len(q) - both):
                    u.append(a.as_py())
                    v.append(b.as_py())
        yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all sets on the left with all on the right.

    A product of 0/1 matrices over the hashes that both sides hold, some columns at a time.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    on_left, on_right = (np.unique(np.concatenate(side)) for side in (left, right))
    columns = np.intersect1d(on_left, on_right, assume_unique=True)
    for c in range(0, len(columns), COLUMNS):
        part = columns[c:c + COLUMNS]
        matrices = []
        for side in (left, right):
            m = np.zeros((len(side), len(part)), np.float32)
            for row, s in enumerate(side):
                at = np.searchsorted(part, s)
                at[at == len(part)] = 0
                m[row, at[part[at] == s]] = 1
            matrices.append(m)
        out += matrices[0] @ matrices[1].T
    return out.astype(np.int64)


def _blocks(batches, percent: int):
    """Links between different components in each block pair; its rows follow each other."""
    def links(rows):
        left, right = [r for r in rows if r[3]], [r for r in rows if not r[3]]
        if not left or not right:
            return
        p, q = ([r[6] for r in side] for side in (left, right))
        sizes = np.array([len(x) for x in p])[:, None] + np.array([len(x) for x in q])[None, :]
        other = np.array([r[5] for r in left])[:, None] != np.array([r[5] for r in right])[None, :]
        both = overlaps(p, q)
        for a, b in zip(*np.nonzero(other & (100 * both >= percent * (sizes - both)))):
            x, y = left[a][4], right[b][4]
            yield min(x, y), max(x, y)

    def table(pairs):
        return pa.record_batch([pa.array([p[n] for p in pairs], pa.int64()) for n in (0, 1)], names=["u", "v"])

    rows, at = [], None
    for batch in batches:
        for *row, held in zip(*batch.columns):
            row = [x.as_py() for x in row]
            if row[:3] != at:
                if found := list(links(rows)):
                    yield table(found)
                rows, at = [], row[:3]
            rows.append((*row, _hashes(held).copy()))       # a block pair outlives its batch
    yield table(list(links(rows)))


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = 75, permutations: int = PERMUTATIONS,
                    band_rows: int = BAND_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    name = "minhash"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = common.stored(docs.mapInArrow(partial(_sign, k=k, permutations=permutations, rows=band_rows),
                                           "doc_id long, n_shingles long, set_key binary, bands array<long>"), f"{name}-signed")
    classes = signed.where("doc_id is not null and set_key is not null")
    # Copies: one row for each distinct set, folded before the shuffle.
    reps = common.stored(classes.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                                                        F.first("bands").alias("bands")), f"{name}-sets")
    links = _links(reps, docs, k, percent, name)
    same_set = (classes.select("doc_id", "set_key").join(reps.select("set_key", "rep"), "set_key")
                .select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    found = common.components(links.unionByName(same_set), name)
    return (signed.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def _links(reps: DataFrame, docs: DataFrame, k: int, percent: int, name: str) -> DataFrame:
    """Confirmed links (u, v) that join all candidates which the full sets link, directly or by a path."""
    members = reps.select("rep", "n", F.explode("bands").alias("key"))
    shared = members.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("c")).where("c > 1")
    members = common.stored(members.join(shared.select("key", "hub"), "key"), f"{name}-members")
    asked = members.select("rep").distinct().join(reps.select("rep", "set_key"), "rep")
    sets = common.stored(docs.join(asked, F.col("doc_id") == F.col("rep"), "left_semi")
                         .mapInArrow(partial(_sets, k=k), "rep long, set_key binary, hashes binary")
                         .join(asked, ["rep", "set_key"], "left_semi").select("rep", "hashes"), f"{name}-hashes")

    pairs = members.where("rep <> hub").select(F.col("hub").alias("u"), F.col("rep").alias("v")).distinct()
    paired = (pairs.join(sets.toDF("u", "x"), "u").join(sets.toDF("v", "y"), "v").select("u", "v", "x", "y"))
    links = common.stored(paired.mapInArrow(partial(_confirm, percent=percent), "u long, v long"), f"{name}-links")

    comp = common.components(links, name)
    labelled = (members.select("key", "rep").join(comp, F.col("rep") == F.col("node"), "left")
                .select("key", "rep", F.coalesce("component", "rep").alias("comp")))
    split = (labelled.groupBy("key", "comp").agg(F.count("*").alias("c"))
             .groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("m"), F.sum("c").alias("c"))
             .where("m < c").select("key", "main", F.ceil(F.col("c") / BLOCK_DOCS).alias("wide"),
                                    F.ceil((F.col("c") - F.col("m")) / BLOCK_DOCS).alias("high")))
    open_ = common.stored(labelled.join(split, "key"), f"{name}-open")
    # Tasks (key, i, j): block i of the members outside the bucket's main component against block j of all its members.
    i = F.pmod(F.xxhash64("rep", F.lit(1)), "high")
    j = F.pmod(F.xxhash64("rep", F.lit(2)), "wide")
    rows = (open_.where("comp <> main").select("key", i.alias("i"), F.explode(F.sequence(F.lit(0), F.col("wide") - 1)).alias("j"), F.lit(True).alias("rest"), "rep", "comp")
            .unionByName(open_.select("key", F.explode(F.sequence(F.lit(0), F.col("high") - 1)).alias("i"), j.alias("j"), F.lit(False).alias("rest"), "rep", "comp")))
    dealt = rows.join(sets, "rep").select("key", "i", "j", "rest", "rep", "comp", "hashes")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    late = (dealt.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(partial(_blocks, percent=percent), "u long, v long"))
    return links.unionByName(common.stored(late, f"{name}-links").distinct())
