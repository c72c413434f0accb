"""Sharding by a Feistel permutation of global row numbers (law ``rows``).

Rows are numbered in the order of doc_id over the whole table; the keyed permutation of
the numbers is the shuffle. A row at permuted place p goes to shard p mod n, slot
p div n: shard sizes differ by one at most, slots have no gaps, and place, shard and slot
of any row number can be computed alone. Built-in functions only.

Defined results: null text counts as empty; rows without doc_id come first; rows that
share a doc_id are ordered by a hash of all their columns (fully equal rows are
interchangeable); an empty table gives an empty result. Copies are rows like others: a
group of copies is spread over all shards. Extra columns pass through ``shuffle``; a column
named shard or slot is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.llm import common, feistel

SHARDS = 8
SEED = "shard"


def shuffle(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """All rows and columns of ``docs`` with ``shard`` (int) and ``slot`` (long)."""
    docs = docs.drop("shard", "slot")
    names = [F.col(f"`{c}`") for c in docs.columns]
    order = [F.col("doc.doc_id"), F.col("mark")]
    rows = docs.select(F.struct(*names).alias("doc"), F.xxhash64(*(c for c, n in zip(names, docs.columns) if n != "doc_id")).alias("mark"))
    rows, n = common.numbered(rows, order, "shards", "row")
    placed = feistel.shuffled(rows, "row", "place", n, seed)
    return placed.select(*(F.col("doc").getField(c).alias(c) for c in docs.columns), (F.col("place") % n_shards).cast("int").alias("shard"),
                         F.floor((F.col("place") - F.col("place") % n_shards) / n_shards).cast("long").alias("slot"))


def digest(docs: DataFrame, n_shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    raw = common.text_or_empty().cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    return (shuffle(narrow, n_shards, seed)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def place_sql(rows: str, n_shards: int = SHARDS, seed: str = SEED) -> str:
    """DuckDB CTEs: ``rows`` is a relation with the 0-based number ``rn``; ``placed`` adds shard and slot."""
    step = feistel.once_sql("x", "a", "b", seed)
    return f"""
    dims AS (SELECT n, a, greatest(1, (n + a - 1) // a) AS b FROM
             (SELECT count(*) AS n, (CASE WHEN count(*) > 0 THEN floor(sqrt(count(*) - 1)) ELSE 0 END)::BIGINT + 1 AS a FROM {rows})),
    walk AS (SELECT rn, n, a, b, {step} AS x FROM (SELECT rn, rn AS x, n, a, b FROM {rows}, dims)
             UNION ALL SELECT rn, n, a, b, {step} AS x FROM walk WHERE x >= n),
    placed AS (SELECT r.*, (w.x % {n_shards})::INTEGER AS shard, w.x // {n_shards} AS slot FROM {rows} r JOIN walk w ON r.rn = w.rn AND w.x < w.n)"""
