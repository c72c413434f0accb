"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints: of all 3-word shingles of a text (A-Z lower-cased, repeats included), bit i is 1 if
it is set in over half of the shingles' XXH64 values.

Copies fold first: one row for each distinct fingerprint. These are sorted by Gray rank, in which
neighbours differ in few bits, and cut into blocks of ``BLOCK``. An upper node keeps what the
fingerprints below it share: a mask of the bits on which all agree, and their pattern. Differences
on shared bits bound the distance from below, so the join goes down from the root with pairs of
nodes and drops every pair whose differences pass the limit, with all that lies under it. Pairs of
blocks that are left meet in a task, where the fingerprints of one go down the tree of the other:
a node there holds only the bits that its parent does not, and a branch ends as soon as the
accumulated differences pass the limit.

Every link is found: the bound never exceeds the distance. A block pair returns a spanning forest of
its links, so a dense group of fingerprints gives no more edges than members. With 2^k blocks a
block meets about k * k / 2 others, whatever their number; a task holds two blocks at a time.

Defined results: null text, no words: fingerprint zero, linked like any other. Fewer than three
words: the whole sequence is the one shingle. Rows that share a doc_id are separate rows, each in
the class of its own fingerprint; ``component_id`` is the smallest doc_id of the class, so a row
without doc_id has one too (null if no member of its class has a doc_id). An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm import common

WORDS = 3              # words in a shingle
SEED = 42              # of XXH64
DISTANCE = 2           # differing bits of a link, at most
BLOCK = 2048           # fingerprints in a block
FAN = 16               # children of an upper node
LEAVES = 8             # children of a node in a block's tree
STEP = 1 << 15         # shingles counted at once
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(raw: bytes | None, width: int = WORDS) -> int:
    """Fingerprint of a UTF-8 text, as an unsigned 64-bit number."""
    words = (raw or b"").lower().split()        # of bytes: ASCII case and white space only
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    width = min(width, len(words))
    n = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        spans = zip(starts[at:min(at + STEP, n)].tolist(), ends[at + width - 1:at + STEP + width - 1].tolist())
        h = np.array([xxhash.xxh64_intdigest(line[i:j], SEED) for i, j in spans], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _signed(batches, width: int):
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def gray_rank(fp: Column) -> Column:
    """Place of a 64-bit word in Gray order, shifted so that signed order is the order of ranks."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


class Tree:
    """The hierarchy over one block's sorted fingerprints; each node holds the shared bits its parent lacks."""

    def __init__(self, words: np.ndarray):
        ones, any_, shared = [words], [words], [np.full(len(words), _ALL)]
        while len(ones[-1]) > 1:
            cuts = np.arange(0, len(ones[-1]), LEAVES)
            ones.append(np.bitwise_and.reduceat(ones[-1], cuts))
            any_.append(np.bitwise_or.reduceat(any_[-1], cuts))
            shared.append(~(ones[-1] ^ any_[-1]))
        self.levels = []                        # from the root down: (mask, pattern)
        for level in range(len(ones) - 1, -1, -1):
            mask = shared[level]
            if level + 1 < len(ones):
                mask = mask & ~shared[level + 1][np.arange(len(mask)) // LEAVES]
            self.levels.append((mask, ones[level] & mask))

    def within(self, queries: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, word) places with at most ``distance`` differing bits."""
        q, node, far = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        for depth, (mask, pattern) in enumerate(self.levels):
            if depth:
                child = (node[:, None] * LEAVES + np.arange(LEAVES)).ravel()
                q, far = np.repeat(q, LEAVES), np.repeat(far, LEAVES)
                real = child < len(mask)
                q, node, far = q[real], child[real], far[real]
            far = far + np.bitwise_count((queries[q] & mask[node]) ^ pattern[node])
            near = far <= distance
            q, node, far = q[near], node[near], far[near]
        return q, node


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (member, smallest member) that join what the links u - v join."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, label = at[:len(u)], at[len(u):], np.arange(len(nodes))
    while True:
        least, was = np.minimum(label[a], label[b]), label
        label = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == was).all():
            hung = label != np.arange(len(nodes))
            return nodes[hung], nodes[label[hung]]


def _longs(value) -> np.ndarray:
    return value.values.to_numpy().view(np.uint64)


def _joined(batches, distance: int):
    """Spanning links of each block pair (a, b, fingerprints of a, fingerprints of b)."""
    for batch in batches:
        for r in range(batch.num_rows):
            same = batch.column(0)[r].as_py() == batch.column(1)[r].as_py()
            x, y = _longs(batch.column(2)[r]), _longs(batch.column(3)[r])
            i, j = Tree(y).within(x, distance)
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                u, v = forest(x[i].view(np.int64), y[j].view(np.int64))
                yield pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])


def links(words: DataFrame, distance: int = DISTANCE, name: str = "graytree") -> DataFrame:
    """Links (u, v) that join the distinct fingerprints ``fp`` of ``words`` wherever a chain of links does."""
    spark = words.sparkSession
    ranked, n = common.numbered(words.select("fp"), [gray_rank(F.col("fp"))], f"{name}-ranked", "rank")
    if not n:
        return spark.createDataFrame([], "u long, v long")
    blocks = (ranked.groupBy(F.call_function("div", F.col("rank"), F.lit(BLOCK)).alias("id"))
              .agg(F.array_sort(F.collect_list(F.struct("rank", "fp"))).alias("sorted"), F.bit_and("fp").alias("ones"), F.bit_or("fp").alias("any")))
    blocks = common.stored(blocks.select("id", F.col("sorted.fp").alias("fps"), "ones", "any"), f"{name}-blocks")

    levels, count = [blocks.select("id", "ones", "any")], -(-n // BLOCK)
    while count > 1:
        above = F.call_function("div", F.col("id"), F.lit(FAN)).alias("id")
        levels.append(levels[-1].groupBy(above).agg(F.bit_and("ones").alias("ones"), F.bit_or("any").alias("any")))
        count = -(-count // FAN)
    pairs = spark.createDataFrame([(0, 0)], "a long, b long")
    for nodes in reversed(levels[:-1]):
        def side(s: str, nodes: DataFrame = nodes) -> DataFrame:
            return nodes.select(F.call_function("div", F.col("id"), F.lit(FAN)).alias(s), F.col("id").alias(f"id_{s}"),
                                F.col("ones").alias(f"ones_{s}"), F.expr("~(ones ^ any)").alias(f"shared_{s}"))

        pairs = (pairs.join(side("a"), "a").join(side("b"), "b")
                 .where(F.expr(f"id_a <= id_b AND bit_count((ones_a ^ ones_b) & shared_a & shared_b) <= {distance}"))
                 .select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = common.stored(pairs.repartition(parts, "a", "b"), f"{name}-pairs")
    met = (pairs.join(blocks.select(F.col("id").alias("a"), F.col("fps").alias("x")), "a")
           .join(blocks.select(F.col("id").alias("b"), F.col("fps").alias("y")), "b").select("a", "b", "x", "y"))
    return common.stored(met.mapInArrow(partial(_joined, distance=distance), "u long, v long"), f"{name}-links").distinct()


def near_duplicates(docs: DataFrame, width: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id."""
    name = "graytree"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    signed = common.stored(rows.mapInArrow(partial(_signed, width=width), "doc_id long, fp long"), f"{name}-signed")
    words = common.stored(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")), f"{name}-words")
    found = common.components(links(words, distance, name), name)
    classes = common.stored(words.join(found, F.col("fp") == F.col("node"), "left")
                            .select("fp", "rep", F.coalesce("component", "fp").alias("class")), f"{name}-classes")
    least = classes.groupBy("class").agg(F.min("rep").alias("component_id"))
    named = common.stored(classes.join(least, "class").select("fp", "component_id"), f"{name}-named")
    return (signed.join(named, "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
