"""Language identification by rank-order n-gram profiles (out-of-place distance).

Training counts the character n-grams (1 to 3, words padded by one space) of a bounded
sample of labelled documents, and keeps every language's most frequent ones in rank
order. A document's own most frequent n-grams, from its whole text, are compared with
each profile: an n-gram costs the difference of its two ranks, or the profile length if
the profile lacks it. The smallest sum names the language; ties go to the name that sorts
first. ``score`` is 1 - distance / largest possible distance, between 0 and 1.

Letters are Unicode letters, lower-cased; everything else separates words.

Profiles of up to ``BLOCK_LANGS`` languages are one block. More languages are dealt into blocks
by a hash of their names; every block names its best language and the smallest distance
of all wins, so the answer is that of one block with all languages. The driver holds one
block's profiles at a time.

Defined results: text that is null or has no letter gives ``und`` with score 0. Rows
without text or lang never train. No labelled rows: everything is ``und``. Repeated rows
are rows like others; other columns are never looked at.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm import common
from squall.session import scratch_path

PROFILE = 400             # n-grams in a profile
TRAIN_PER_LANG = 1000     # documents that train a language, at most
BLOCK_LANGS = 200         # languages whose profiles a task holds at once; more are compared block by block
UND = "und"
GAP = 1                   # stands for the gap between words; no letter, and unlike 0 it counts in an n-gram's integer


@lru_cache(1)
def _letters() -> np.ndarray:
    """For each code point: is it a letter?"""
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(sys.maxunicode + 1)])


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a whole text and their counts; an n-gram is one integer."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.where(letter, codes, GAP).astype(np.uint64)
    keep = letter | np.append(True, letter[:-1])      # one gap between words
    c = np.concatenate([[GAP], codes[keep], [GAP]]).astype(np.uint64)
    if c[1] == GAP:
        c = c[1:]
    if c[-2] == GAP:
        c = c[:-1]
    two = (c[:-1] << np.uint64(21)) | c[1:]
    three = (two[:-1] << np.uint64(21)) | c[2:]
    inside = c[1:-1] != GAP                            # "x y" spans two words
    return np.unique(np.concatenate([c[c != GAP], two, three[inside]]), return_counts=True)


def top(grams: np.ndarray, counts: np.ndarray, n: int = PROFILE) -> np.ndarray:
    """The n most frequent n-grams, most frequent first; ties by code points."""
    return grams[np.lexsort((grams, -counts))[:n]]


class Profiles:
    """Every language's rank of every n-gram that any profile has."""

    def __init__(self, ranked: dict[str, list[int]], size: int = PROFILE):
        self.names = sorted(ranked)
        self.size = size
        self.grams = np.unique(np.array([g for v in ranked.values() for g in v], np.uint64))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int32)
        for k, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, np.array(ranked[name], np.uint64)), k] = np.arange(len(ranked[name]))

    def nearest(self, text: str | None) -> tuple[str | None, int, int]:
        """The nearest language, its distance, and the number of the text's own n-grams compared."""
        own = top(*ngram_counts(text), self.size)
        if not len(own) or not self.names:
            return None, 0, 0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        rows = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[rows]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.names[best], int(apart[best]), len(own)

    def guess(self, text: str | None) -> tuple[str, float]:
        name, apart, n = self.nearest(text)
        return (UND, 0.0) if name is None else (name, float(1 - apart / (n * self.size)))


def _counts(batches):
    for batch in batches:
        langs, grams, counts = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            g, c = ngram_counts(text.as_py())
            langs += [lang] * len(g)
            grams.append(g.view(np.int64))
            counts.append(c)
        yield pa.record_batch([pa.array(langs, pa.string()), pa.array(np.concatenate([np.empty(0, np.int64), *grams])),
                               pa.array(np.concatenate([np.empty(0, np.int64), *counts]))], names=["lang", "gram", "n"])


def train(labelled: DataFrame, size: int = PROFILE, per_lang: int = TRAIN_PER_LANG, block: int = BLOCK_LANGS) -> list[Profiles]:
    """Blocks of profiles from rows (doc_id, text, lang): about ``per_lang`` documents of each language at most.

    Documents are drawn by a hash of their doc_id, so the sample does not depend on the
    partitioning. Up to ``block`` languages are one block, whose sizes and profiles reach the driver; beyond, the sizes
    stay a table and the blocks hold ``block / 2`` languages on average.
    """
    rows = labelled.where("text is not null and lang is not null").select("doc_id", "lang", "text")
    spark = rows.sparkSession
    sizes = common.stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "lang-sizes")
    langs = sizes.count()
    if not langs:
        return [Profiles({}, size)]
    blocks = 1 if langs <= block else -(-2 * langs // block)
    share = sizes.select("lang", (F.least(F.lit(1.0), F.lit(float(per_lang)) / F.col("n")) * 2**32).cast("long").alias("below"))
    drawn = (rows.join(F.broadcast(share) if blocks == 1 else share, "lang")
             .where(F.crc32(F.concat(F.lit("train:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))) < F.col("below")))
    counts = (drawn.select("lang", "text").mapInArrow(_counts, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = (counts.withColumn("at", F.row_number().over(first)).where(F.col("at") <= size)
            .withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(blocks)).cast("int")))
    if blocks > 1:
        path = scratch_path(spark, "lang-profiles")
        kept.repartition("block").write.partitionBy("block").parquet(path)
        kept = spark.read.schema(kept.schema).parquet(path)
    out = []
    for b in range(blocks):
        ranked: dict[str, list[int]] = {}
        for row in sorted(kept.where(F.col("block") == b).collect(), key=lambda r: (r["lang"], r["at"])):
            ranked.setdefault(row["lang"], []).append(row["gram"])
        if ranked:
            out.append(Profiles(ranked, size))
    return out or [Profiles({}, size)]


def predictor(blocks: list[Profiles], text: Column | str = "text") -> Column:
    """Column struct(lang_pred, score) for a text column."""
    def nearest(profiles: Profiles) -> Column:
        @F.pandas_udf("apart long, lang string, n long")
        def of(texts):
            import pandas as pd
            found = [profiles.nearest(t) for t in texts]
            return pd.DataFrame({"apart": [f[1] for f in found], "lang": [f[0] for f in found], "n": [f[2] for f in found]})

        return of(text)

    # Distance first, then the name; a text without letters has no language in any block.
    best = nearest(blocks[0]) if len(blocks) == 1 else F.array_min(F.array(*[nearest(p) for p in blocks]))
    size = F.lit(float(blocks[0].size))
    return F.transform(F.array(best), lambda b: F.struct(
        F.coalesce(b["lang"], F.lit(UND)).alias("lang_pred"),
        F.when(b["lang"].isNull(), F.lit(0.0)).otherwise(F.lit(1.0) - b["apart"] / (b["n"] * size)).alias("score")))[0]
