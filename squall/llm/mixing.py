"""Mixing sources to target weights by blocks.

Every source's documents, one after the other in a hashed order, are one stream of words cut
into blocks of ``BLOCK_WORDS`` (a small source into at least ``LEAST_BLOCKS`` smaller ones, so that
its share is met as closely). The mix is a number of output shards; how many of a shard's
slots each source fills is a multinomial draw from the source's remaining quota, so the
totals over all shards meet the quotas. The k-th slot that a source fills takes block
pi(k mod blocks) of pass k div blocks, where pi is the source's and the pass's keyed
permutation: a block is used again only after all others were, so no document exceeds the
passes its source needs. Slots and blocks meet in a join on (source, block).

Targets: sources in code-point order of their name (null last) weigh 5, 2, 1, repeating, and
share 150% of all words by weight; a target stops at twice its source's size and the excess
is shared by weight among the others, until none is above.

Sources may be as many as documents: they are a table, like the drawn counts. A multinomial draw over
all sources is drawn in two steps, which together have the same distribution: over ``CELLS`` ranges of
sources on the driver, then in a task for each range over its sources. The level at which targets
are shared is found by sums over the table.

Defined results: null text has no words; a document without words takes nothing; null is
a source of its own; an empty table gives an empty result; rows that share a doc_id are
separate documents (fully equal rows are interchangeable). Extra columns are ignored by the digest and
pass through ``mixed_documents`` whatever their names.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from squall.llm import common, feistel

BLOCK_WORDS = 64
OUT_SHARDS = 64
SHARE = 1.5           # words of the mix / words of all sources
MOST = 2.0            # words taken / words of a source, at most
WEIGHTS = (5, 2, 1)
LEAST_BLOCKS = 64        # blocks of a source, if it has as many words
BUCKET_ROWS = 2_000      # documents whose positions are summed together, about
CELLS = 1024             # ranges of sources that the driver draws for, at most
RUN_SLOTS = 50_000       # slots that are made from one row
SEED = "mix"
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def draws(quotas: list[int], totals: list[int], seed: list[int]) -> np.ndarray:
    """Counts (shard, quota): each shard's multinomial draw of its total from what is left of the quotas."""
    g = np.random.Generator(np.random.PCG64(seed))
    left = np.array(quotas, np.int64)
    out = np.zeros((len(totals), len(quotas)), np.int64)
    for shard, n in enumerate(totals):
        while n > 0:                     # what a quota cannot give is drawn again from the others
            got = np.minimum(g.multinomial(n, left / left.sum()), left)
            out[shard] += got
            left -= got
            n -= int(got.sum())
    return out


def even_totals(total: int, n_shards: int) -> list[int]:
    """Slots of each shard: all but the last alike."""
    per = -(-total // n_shards)
    return [max(0, min(per, total - per * i)) for i in range(n_shards)]


def seed_of(seed: str, *more: int) -> list[int]:
    return [*(ord(c) for c in seed), *more]


def words_of(text: Column) -> Column:
    """Number of runs without ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def water_level(sources: DataFrame, total: float) -> float:
    """The level l at which min(cap, l * weight) of all ``sources`` sum to ``total`` (infinite if all caps do not reach it).

    Sources that are full at a level stay full at a higher one, so the level rises with each sum until
    no further source fills.
    """
    level, full = 0.0, -1
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        held, weight, n = sources.agg(F.sum(F.when(over, F.col("cap"))), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        if weight is None:
            return math.inf
        if n == full:
            return level
        level, full = (total - (held or 0.0)) / weight, n


class Mix:
    """The mix of ``docs`` (doc_id, text, source): sizes, targets, streams, slots and pieces.

    ``row`` names a column that numbers the rows (stored), if there is one.
    """

    def __init__(self, docs: DataFrame, block_words: int = BLOCK_WORDS, out_shards: int = OUT_SHARDS, share: float = SHARE,
                 weights: tuple = WEIGHTS, seed: str = SEED, cells: int = CELLS, row: str | None = None):
        number = F.monotonically_increasing_id() if row is None else F.col(row)
        rows = common.stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", words_of(F.col("text")).alias("size"),
                                         F.xxhash64(F.col("doc_id").cast("long"), "text").alias("mark"), number.alias("row")), "mix-rows")
        held = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
        held, n = common.numbered(held, [F.col("source").isNull(), F.col("source")], "mix-sources", "src")
        weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("src") % len(weights)).cast("int"))
        held = common.stored(held.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size")), "mix-weights")
        total = held.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
        level = water_level(held, share * total)
        target = F.least("cap", F.when(F.col("weight") > 0, F.lit(level) * F.col("weight")))

        def up(a: Column, b: Column) -> Column:
            return F.call_function("div", a + b - 1, b)

        width = F.greatest(F.lit(1), F.least(F.lit(block_words), F.call_function("div", F.col("source_size"), F.lit(LEAST_BLOCKS)))).cast("long")
        a = F.floor(F.sqrt(F.greatest(F.col("blocks") - 1, F.lit(0)))) + 1
        quota = F.when(F.col("source_size") > 0, F.least(F.floor(MOST * F.col("blocks")), F.bround(F.col("target") * F.col("blocks") / F.col("source_size")))).otherwise(0)
        per_cell = max(1, -(-n // cells))
        self.sources = common.stored(
            held.withColumn("target", target).withColumn("width", width).withColumn("blocks", up(F.col("source_size"), F.col("width")))
            .withColumn("a", a).withColumn("b", F.greatest(F.lit(1), up(F.col("blocks"), F.col("a")))).withColumn("quota", quota.cast("long"))
            .withColumn("cell", F.call_function("div", F.col("src"), F.lit(per_cell)).cast("int"))
            .select(F.col("source").alias("name"), "src", "source_size", "target", "width", "blocks", "a", "b", "quota", "cell"), "mix-targets")
        self.documents = rows.join(self.sources.select("name", "src", "source_size", "target"), F.col("source").eqNullSafe(F.col("name")))
        self.seed, self.out_shards, self.n_rows = seed, out_shards, rows.count()
        self.total = self.sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]

    def counts(self) -> DataFrame:
        """Rows (shard, src, count > 0) of the multinomial draws."""
        spark, seed = self.sources.sparkSession, self.seed
        cells = sorted((r[0], r[1]) for r in self.sources.groupBy("cell").agg(F.sum("quota")).collect())     # CELLS rows at most
        drawn = draws([q for _, q in cells], even_totals(self.total, self.out_shards), seed_of(seed))
        totals = [(c, drawn[:, i].tolist()) for i, (c, _) in enumerate(cells)]
        totals = spark.createDataFrame(totals, "cell int, totals array<long>")

        def inside(rows):
            import pandas as pd

            rows = rows.sort_values("src")
            got = draws(rows["quota"].tolist(), list(rows["totals"].iloc[0]), seed_of(seed, int(rows["cell"].iloc[0])))
            shard, i = np.nonzero(got)
            return pd.DataFrame({"shard": shard.astype("int32"), "src": rows["src"].to_numpy()[i], "count": got[shard, i]})

        return common.stored(self.sources.select("cell", "src", "quota").join(totals, "cell").groupBy("cell").applyInPandas(inside, "shard int, src long, count long"), "mix-counts")

    def streams(self) -> DataFrame:
        """Documents (row, doc_id, mark, src, size) with the place ``at`` of their first word in their source's stream.

        The order is by a hash bucket, then by hash: a source, however large, is summed in
        buckets, and a bucket starts after the buckets before it.
        """
        n = max(1, self.n_rows // BUCKET_ROWS)
        rows = self.documents.select("row", "doc_id", "src", "size", "mark", F.pmod(F.xxhash64("mark", F.lit(1)), F.lit(n)).alias("bucket"))
        sums = rows.groupBy("src", "bucket").agg(F.sum("size").alias("held"))
        before = sums.select("src", "bucket", (F.sum("held").over(Window.partitionBy("src").orderBy("bucket")) - F.col("held")).alias("base"))
        inside = Window.partitionBy("src", "bucket").orderBy("mark", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("upto", F.sum("size").over(inside))
        return rows.join(before, ["src", "bucket"]).select("row", "doc_id", "mark", "src", "size", (F.col("base") + F.col("upto") - F.col("size")).alias("at"))

    def pieces(self) -> DataFrame:
        """Parts of documents in blocks: (src, block, row, doc_id, mark, word, n); ``word`` is the first word's place in its document."""
        docs = self.streams().where("size > 0").join(self.sources.select("src", "width"), "src")
        size = F.col("width")
        first = F.call_function("div", F.col("at"), size)
        block = F.explode(F.sequence(first, F.call_function("div", F.col("at") + F.col("size") - 1, size)))
        from_ = F.greatest(F.col("at"), F.col("block") * size)
        to = F.least(F.col("at") + F.col("size"), (F.col("block") + 1) * size)
        return (docs.withColumn("block", block)
                .select("src", "block", "row", "doc_id", "mark", (from_ - F.col("at")).alias("word"), (to - from_).alias("n")))

    def slots(self) -> DataFrame:
        """The mix: (shard, slot, src, block), one row for each slot."""
        spark = self.sources.sparkSession
        per = even_totals(self.total, self.out_shards)
        shards = spark.createDataFrame([(j, n, *feistel.sides(n)) for j, n in enumerate(per)], "shard int, n long, sa long, sb long").coalesce(1)
        # A shard's draws lie one source after the other; a source's uses go on from shard to shard.
        counts = self.counts()
        in_shard, in_source = (Window.partitionBy(p).orderBy(o).rowsBetween(Window.unboundedPreceding, Window.currentRow) for p, o in (("shard", "src"), ("src", "shard")))
        runs = (counts.withColumn("turn", F.sum("count").over(in_shard) - F.col("count")).withColumn("k", F.sum("count").over(in_source) - F.col("count"))
                .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("count") - 1, F.lit(RUN_SLOTS))))))
        runs = common.stored(runs.join(self.sources.select("src", "blocks", "a", "b"), "src").join(F.broadcast(shards), "shard")
                             .repartition(1 + self.total // (4 * RUN_SLOTS), "shard", "src", "part"), "mix-runs")
        i = F.explode(F.sequence(F.col("part") * RUN_SLOTS, F.least(F.col("count"), (F.col("part") + 1) * RUN_SLOTS) - 1))
        slots = (runs.withColumn("i", i).withColumn("turn", F.col("turn") + F.col("i")).withColumn("k", F.col("k") + F.col("i")))
        outside = (shards.select("n", F.col("sa").alias("a"), F.col("sb").alias("b")).distinct().where("n > 0 and a * b > n")
                   .select("*", F.explode(F.expr("sequence(n, a * b - 1)")).alias("x")))
        walk = feistel.longest_walk(outside, f"{self.seed}-slot", portable=False)
        slots = slots.withColumn("slot", feistel.permuted(F.col("turn"), F.col("n"), F.col("sa"), F.col("sb"), f"{self.seed}-slot", walk, portable=False))
        slots = slots.withColumn("pass", ((F.col("k") - F.col("k") % F.col("blocks")) / F.col("blocks")).cast("long"))
        # Sources and passes rotate the index before the permutation, so each has an order of its own.
        turned = F.xxhash64("src", "pass").bitwiseAND(F.lit((1 << 31) - 1))
        slots = slots.withColumn("x", (F.col("k") + turned) % F.col("blocks"))
        outside = (self.sources.where("blocks > 0 and a * b > blocks").select(F.col("blocks").alias("n"), "a", "b").distinct()
                   .select("*", F.explode(F.expr("sequence(n, a * b - 1)")).alias("x")))
        depth = feistel.longest_walk(outside, self.seed, portable=False)
        return slots.select("shard", "slot", "src", feistel.permuted(F.col("x"), F.col("blocks"), F.col("a"), F.col("b"), self.seed, depth, portable=False).alias("block"))

    def mixed(self) -> DataFrame:
        """The mix's content: slots joined with their blocks' document parts."""
        return self.slots().hint("merge").join(self.pieces(), ["src", "block"])      # slots are many more than the runs they are made from

    def digest(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken."""
        taken = self.mixed().groupBy("row").agg(F.sum("n").alias("got"))
        return (self.documents.join(taken, "row", "left")
                .select("doc_id", "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken")))

    def used(self) -> DataFrame:
        """The documents' parts with how often the mix takes them."""
        return self.mixed().groupBy("src", "block", "row", "doc_id", "mark", "word", "n").agg(F.count("*").alias("uses"))


def passages(text: str | None, parts: list[tuple[int, int, int]]) -> list[str]:
    """The passages that the mix takes from a text, repeats included.

    ``parts``: (first word, words, uses), disjoint. Neighbouring parts are one passage as
    often as all are used, so a document whose parts are all taken stays whole.
    """
    at = [m.span() for m in _WORDS.finditer(text or "")]
    out = []
    for layer in range(1, max((u for _, _, u in parts), default=0) + 1):
        runs: list[list[int]] = []
        for word, n, uses in sorted(parts):
            if uses >= layer:
                if runs and runs[-1][1] == word:
                    runs[-1][1] = word + n
                else:
                    runs.append([word, word + n])
        out += [text if (i, j) == (0, len(at)) else text[at[i][0]:at[j - 1][1]] for i, j in runs]
    return out


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix as documents: every column of ``docs``, one row for each passage taken, n_chars renewed if there is one."""
    rows = common.marked(docs, "mix-documents")
    with common.passing(docs.sparkSession):
        mix = Mix(rows.select("row", "doc.doc_id", "doc.text", "doc.source"), row="row", **how)
        parts = common.stored(mix.used().groupBy("row").agg(F.collect_list(F.struct("word", "n", "uses")).alias("parts")), "mix-parts", keep=True)

    @F.pandas_udf("array<string>")
    def cut(texts, lists):
        import pandas as pd
        return pd.Series([passages(t, [(p["word"], p["n"], p["uses"]) for p in ps]) for t, ps in zip(texts, lists)])

    taken = rows.join(parts, "row").select("doc", F.explode(cut("doc.text", "parts")).alias("passage"))
    new = {"text": F.col("passage"), "n_chars": F.length("passage").cast("long")}
    return taken.select(*((new[c] if c in new else F.col("doc").getField(c)).alias(c) for c in docs.columns))
