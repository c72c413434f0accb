"""Hard negatives by anchor-clustered shared lists, walked to a certified end (MAXIMUS style).

Vectors of integers; a row's score is its inner product with the anchor, higher first, ties by the
smaller id. An anchor's positives are its ``POSITIVES`` best other rows of the same label. For each
positive the negatives are the ``NEGATIVES`` best rows of another label whose score is between
``LOW`` and ``HIGH`` per cent of the positive's.

Anchors are clustered by direction (spherical k-means, centroids fitted on at most ``FIT_ROWS``
anchors, the only sample here). If a cluster's members lie within the angle t of its centroid, then
``|row| cos(max(0, angle(row, centroid) - t))`` bounds the score of the row for every member of
length one. A cluster's list of all rows falls in that bound; it is sorted once, and all members
share it: rows are stored in blocks of neighbours, the list holds the blocks by their largest bound,
and a task orders a block's rows. A member's walk ends where the bound times its length is below the
worst score that it would still take, so what it leaves out is certified and the result is that of
brute force.

The positives are walked for first, then the negatives, whose windows then are known. Either walk
starts with the head of the list; the worst scores held then say how far the rest must be read, and
blocks beyond that are not even sent. The rest is dealt in turn over slices of about ``LIST_ROWS``
rows, each walked by one task for one group of at most about ``GROUP`` anchors, and a window for
each anchor merges the few best rows of the slices. Groups and blocks meet by their numbers in a
join, and are scored as matrix products. How much is pruned is up to the data: directions without
clusters, as random ones are, leave little, and then the work is that of all anchors against all rows.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part, and neither do rows without id. Shorter vectors end in zeros. Rows that share an id are rows of
their own. Scores are exact: a component of ``LARGEST`` or more after scaling takes its row out, so
that scores fit a long. Anchors without positives or without negatives have no rows in the result.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from squall.llm import common

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90      # per cent of the positive's score
SCALE = 256
LARGEST = 1 << 25
FIT_ROWS = 4096         # anchors that the centroids are fitted on, at most
CLUSTER = 1024          # anchors for each cluster, about
CLUSTERS = 32           # at most
GROUP = 512             # anchors that walk together
BLOCK = 1024            # rows in a block
HEAD = 8                # blocks in the head of a list
LIST_ROWS = 65_536      # rows of a list that one task walks, about
ROUNDS = 12             # of k-means
SLACK = 1e-6            # against rounding in angles
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def participants(rows: DataFrame) -> DataFrame:
    """Rows (id, label, vec array<int>) that take part, from (vec_id, label, embedding)."""
    x = F.transform("embedding", lambda v: v.cast("double") * SCALE)
    good = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < LARGEST), F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "embedding")
    return (rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & good)
            .select("id", "label", F.transform(x, lambda v: F.floor(v).cast("int")).alias("vec")))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list<int> array as a matrix; shorter rows end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy()
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows; by floating point where that is exact."""
    top = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if top < 2**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left.astype(np.int64) @ right.T.astype(np.int64)


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay), and the lengths."""
    size = np.sqrt((m.astype(np.float64) ** 2).sum(axis=1))
    return m / np.where(size == 0, 1, size)[:, None], size


def centroids(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit centroids of a bounded sample of anchors: spherical k-means from far-apart starts."""
    points, _ = unit(sample)
    starts, far = [0], np.full(len(points), np.inf)
    while len(starts) < min(count, len(points)):
        far = np.minimum(far, 1 - points @ points[starts[-1]])
        starts.append(int(far.argmax()))
    centres = points[starts]
    for _ in range(ROUNDS):
        sums = np.zeros_like(centres)
        np.add.at(sums, (points @ centres.T).argmax(axis=1), points)
        moved, size = unit(sums)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


def bounds(m: np.ndarray, centres: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """For each row and cluster: no member of length one within the cluster's width scores more."""
    points, size = unit(m)
    past = np.arccos(np.clip(points @ centres.T, -1, 1)) - widths[None, :]
    return size[:, None] * (np.cos(np.maximum(past, 0)) + SLACK)


def _nearest(batches, centres: np.ndarray):
    """Rows with their nearest centroid and the angle to it."""
    for batch in batches:
        cos = unit(matrix(batch.column(3), centres.shape[1]))[0] @ centres.T
        angle = np.arccos(np.clip(cos.max(axis=1), -1, 1))
        yield pa.record_batch([*batch.columns, pa.array(cos.argmax(axis=1), pa.int32()), pa.array(angle)],
                              names=["row", "id", "label", "vec", "cell", "angle"])


def _listed(batches, centres: np.ndarray, widths: np.ndarray):
    """List entries (cell, block, the block's largest bound), from (block, vectors)."""
    for batch in batches:
        found = [bounds(matrix(batch.column(1).slice(r, 1).flatten(), centres.shape[1]), centres, widths).max(axis=0) for r in range(batch.num_rows)]
        yield pa.record_batch([pa.array(np.tile(np.arange(len(centres), dtype=np.int32), batch.num_rows)),
                               pa.array(np.repeat(batch.column(0).to_numpy(), len(centres))), pa.array(np.concatenate([np.empty(0), *found]))],
                              names=["cell", "block", "bound"])


class Best:
    """The best rows so far for each key, ``most`` for a key; ``worst`` is the score that a key still takes."""

    def __init__(self, floors: np.ndarray, most: int):
        self.most, self.worst = most, floors.copy()
        self.held = [np.empty(0, np.int64) for _ in range(4)]

    def add(self, *found: np.ndarray) -> None:
        """Take (key, score, id, row) arrays in."""
        key, score, ident, row = (np.concatenate(pair) for pair in zip(self.held, found))
        order = np.lexsort((row, ident, -score, key))
        key, score, ident, row = key[order], score[order], ident[order], row[order]
        rank = np.arange(len(key)) - np.searchsorted(key, key)
        keep, last = rank < self.most, rank == self.most - 1
        self.held = [x[keep] for x in (key, score, ident, row)]
        self.worst[key[last]] = score[last]


class Walk:
    """One group of asks on its way down a list. An ask is an anchor's search for the best rows in a window of scores."""

    def __init__(self, asks: pa.StructArray, cell: int, same: bool, most: int, centres: np.ndarray, widths: np.ndarray):
        self.row, self.ask, label, self.low, self.high, floor = (asks.field(n).to_numpy() for n in ("row", "ask", "label", "low", "high", "floor"))
        at, self.first, self.count = np.unique(self.row, return_index=True, return_counts=True)     # asks come by row
        vectors = matrix(asks.field("vec").take(pa.array(self.first)), centres.shape[1])
        self.rows, self.labels, self.vectors = at, label[self.first], vectors
        self.size = np.repeat(unit(vectors)[1], self.count)
        self.best, self.same = Best(np.maximum(floor, self.low), most), same
        self.centre, self.width = centres[cell:cell + 1], widths[cell:cell + 1]

    def least_bound(self) -> float:
        """The bound below which no ask takes a row."""
        free = (self.best.worst == LEAST) | (self.size == 0)
        return float(np.where(free, -np.inf, self.best.worst / np.where(free, 1, self.size)).min())

    def block(self, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        bound = bounds(vectors, self.centre, self.width)[:, 0]
        order = np.argsort(-bound, kind="stable")
        order = order[:np.searchsorted(-bound[order], -self.least_bound(), side="right")]
        got = scores(self.vectors, vectors[order])
        of_label = self.labels[:, None] == labels[order][None, :]
        worst = np.minimum.reduceat(self.best.worst, self.first)
        member, col = np.nonzero((of_label if self.same else ~of_label) & (got >= worst[:, None]) & (self.rows[:, None] != rows[order][None, :]))
        # Each hit meets all asks of its anchor.
        n = self.count[member]
        key = np.repeat(self.first[member], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        score, col = np.repeat(got[member, col], n), np.repeat(order[col], n)
        good = (score >= self.best.worst[key]) & (score <= self.high[key])
        key, score, col = key[good], score[good], col[good]
        self.best.add(key, score, ids[col], rows[col])


_FOUND = pa.schema([("row", pa.int64()), ("ask", pa.int32()), ("score", pa.int64()), ("id", pa.int64()), ("found", pa.int64())])


def _walked(batches, same: bool, most: int, centres: np.ndarray, widths: np.ndarray):
    """Best rows of each ask, from a stream of groups, each followed by the blocks of its slice of the list."""
    walk = None

    def result():
        key, score, ident, row = walk.best.held
        return pa.record_batch([pa.array(walk.row[key]), pa.array(walk.ask[key]), pa.array(score), pa.array(ident), pa.array(row)], schema=_FOUND)

    ended = False
    for batch in batches:
        for r in range(batch.num_rows):
            asks = batch.column("asks")[r].values
            if asks is not None:
                if walk is not None:
                    yield result()
                walk, ended = Walk(asks, batch.column("cell")[r].as_py(), same, most, centres, widths), False
            elif not ended:
                ended = batch.column("bound")[r].as_py() < walk.least_bound()
                if not ended:
                    walk.block(*(batch.column(n)[r].values.to_numpy() for n in ("ids", "rows", "labels")),
                               matrix(batch.column("vecs")[r].values, centres.shape[1]))
    if walk is not None:
        yield result()


class Miner:
    """Blocks of all rows, the anchors in groups, and each cluster's list."""

    def __init__(self, rows: DataFrame, anchors: Column, cluster: int = CLUSTER, group: int = GROUP, block: int = BLOCK, head: int = HEAD, list_rows: int = LIST_ROWS):
        rows = common.stored(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "vec"), "hardneg-rows")
        chosen = rows.where(anchors)
        n, dims = rows.agg(F.count("*"), F.max(F.size("vec"))).first()
        self.n_anchors, self.head = chosen.count(), head
        self.spark = rows.sparkSession
        if not self.n_anchors:
            return
        sample = chosen.orderBy(F.xxhash64("row"), "row").limit(FIT_ROWS).select("vec").toArrow().column("vec").combine_chunks()
        self.centres = centroids(matrix(sample, dims), min(CLUSTERS, -(-self.n_anchors // cluster)))
        near = partial(_nearest, centres=self.centres)
        schema = "row long, id long, label long, vec array<int>, cell int, angle double"
        members = common.stored(chosen.mapInArrow(near, schema), "hardneg-anchors")
        sizes = {r[0]: (r[1], r[2]) for r in members.groupBy("cell").agg(F.max("angle"), F.count("*")).collect()}
        self.widths = np.array([sizes.get(c, (0.0, 0))[0] for c in range(len(self.centres))])
        groups = F.array(*(F.lit(-(-sizes.get(c, (0, 1))[1] // group)) for c in range(len(self.centres))))
        self.members = members.withColumn("part", F.pmod(F.xxhash64("row"), F.get(groups, F.col("cell"))).cast("int"))
        placed, _ = common.numbered(rows.mapInArrow(near, schema), [F.col("cell"), F.col("angle"), F.col("row")], "hardneg-placed", "place")
        blocks = (placed.groupBy(F.call_function("div", F.col("place"), F.lit(block)).alias("block"))
                  .agg(F.array_sort(F.collect_list(F.struct("id", "row", "label", "vec"))).alias("held"))
                  .select("block", F.col("held.id").alias("ids"), F.col("held.row").alias("rows"), F.col("held.label").alias("labels"), F.col("held.vec").alias("vecs")))
        self.blocks = common.stored(blocks, "hardneg-blocks")
        entries = self.blocks.select("block", "vecs").mapInArrow(partial(_listed, centres=self.centres, widths=self.widths), "cell int, block long, bound double")
        by_bound = Window.partitionBy("cell").orderBy(F.col("bound").desc(), "block")
        self.lists = common.stored(entries.withColumn("rank", F.row_number().over(by_bound) - 1), "hardneg-lists")
        self.slices = -(-n // list_rows)

    def walk(self, asks: DataFrame, entries: DataFrame, slices: int, same: bool, most: int) -> DataFrame:
        """Best rows (row, ask, score, id, found) of each ask (cell, part, row, ask, label, vec, low, high, floor) among the entries (cell, part, block, bound, rank)."""
        held = F.array_sort(F.collect_list(F.struct("row", "ask", "label", "low", "high", "floor", "vec"))).alias("asks")
        groups = asks.groupBy("cell", "part").agg(held).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        dealt = entries.withColumn("slice", (F.col("rank") % slices).cast("int")).join(self.blocks, "block").drop("block")
        stream = groups.withColumn("rank", F.lit(-1)).unionByName(dealt, allowMissingColumns=True)
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        stream = (stream.repartition(parts, "cell", "part", "slice").sortWithinPartitions("cell", "part", "slice", "rank")
                  .select("cell", "bound", "asks", "ids", "rows", "labels", "vecs"))
        return stream.mapInArrow(partial(_walked, same=same, most=most, centres=self.centres, widths=self.widths),
                                 "row long, ask int, score long, id long, found long")

    def best(self, asks: DataFrame, same: bool, most: int, name: str) -> DataFrame:
        """The best rows of each ask (row, ask, low, high and its anchor's columns), from the head of the list and then from what of the rest can still count."""
        asks = common.stored(asks.withColumn("floor", F.lit(LEAST)), f"hardneg-{name}")
        groups = asks.select("cell", "part").distinct()
        top = common.stored(self.walk(asks, self.lists.where(F.col("rank") < self.head).join(groups, "cell"), 1, same, most), f"hardneg-{name}-head")
        full = top.groupBy("row", "ask").agg(F.count("*").alias("n"), F.min("score").alias("worst")).where(F.col("n") == most)
        asks = common.stored(asks.drop("floor").join(full.select("row", "ask", F.col("worst").alias("floor")), ["row", "ask"], "left")
                             .fillna(LEAST, ["floor"]), f"hardneg-{name}-floors")
        size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v))
        worst = F.greatest("low", "floor")
        need = F.when((worst == LEAST) | (size == 0), F.lit(float("-inf"))).otherwise(worst / size)
        reach = asks.groupBy("cell", "part").agg(F.min(need).alias("need"))
        rest = (self.lists.where(F.col("rank") >= self.head).join(reach, "cell").where("bound >= need").drop("need"))
        found = common.stored(top.unionByName(self.walk(asks, rest, self.slices, same, most)), f"hardneg-{name}-found")
        place = F.row_number().over(Window.partitionBy("row", "ask").orderBy(F.col("score").desc(), "id", "found"))
        return found.withColumn("place", place).where(F.col("place") <= most)


def mine(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, **how) -> DataFrame:
    """For each anchor (a row of (id, label, vec) where ``anchors`` holds) and positive its hard negatives:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank."""
    miner = Miner(rows, anchors, **how)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    if not miner.n_anchors:
        return miner.spark.createDataFrame([], out)
    columns = ["cell", "part", "row", "label", "vec"]
    near = miner.best(miner.members.select(*columns, F.lit(0).alias("ask"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high")), True, positives, "positives")
    near = near.select("row", F.col("place").alias("ask"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    # low * score <= 100 * negative <= high * score has solutions from a score of zero on.
    window = [F.call_function("div", F.col("positive_score") * low + 99, F.lit(100)).alias("low"), F.call_function("div", F.col("positive_score") * high, F.lit(100)).alias("high")]
    asks = miner.members.join(near.where("positive_score >= 0"), "row").select(*columns, "ask", *window)
    hard = miner.best(asks, False, negatives, "negatives")
    return (hard.select("row", "ask", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near, ["row", "ask"]).join(miner.members.select("row", F.col("id").alias("anchor_id")), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", F.col("ask").alias("positive_rank")))


SQL = """
WITH good AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
              FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
           FROM good a JOIN good b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS positive_rank
              FROM scored WHERE same QUALIFY positive_rank <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score, positive_rank::INTEGER AS positive_rank
FROM positives JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10
"""
