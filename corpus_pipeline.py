"""The corpus pipeline: documents to shards, in stages that each write and reread Parquet.

A stage decides on a row in place or by a stored row number, never by doc_id: rows without doc_id, rows that
share one and equal rows are rows of their own. Columns may have any names and pass through; an empty
table gives an empty result; whole texts are read, whatever their length. Ties are broken by doc_id
(nulls last), then by the row's number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import common, decontam, langid, minhash, mixing, shards

MIN_SCORE = 0.25      # language scores below this fit no learned language
MIX_BLOCK = 256       # words in a block of the mix


def _columns(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.select(*(F.col("doc").getField(c).alias(c) for c in names))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; null texts, texts without letters or far from every profile go.

    Profiles learn from the labelled documents themselves; without any label nothing is recognised.
    """
    common.bounded_batches(spark)
    profiles = langid.train(docs.where("doc_id is not null"))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    rows = docs.select(whole.alias("doc"), langid.predictor(profiles, "text").alias("guess"))
    return _columns(rows.where((F.col("guess.lang_pred") != langid.UND) & (F.col("guess.score") >= MIN_SCORE)), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group: that of the smallest doc_id. Texts without words are no duplicates."""
    common.bounded_batches(spark)
    rows = common.marked(docs, "dedup-documents")
    with common.passing(spark):
        found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text")).select(F.col("doc_id").alias("row"), "component_id")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "row"))["row"]
        stay = found.join(rows.select("row", "doc.doc_id"), "row").groupBy("component_id").agg(first.alias("row"))
        stay = common.stored(stay.select("row"), "dedup-kept", keep=True)
    return _columns(rows.join(stay, "row", "left_semi"), docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item within its edit budget."""
    common.bounded_batches(spark)
    return decontam.without(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The passages that the mix takes, one row for each; a document taken whole stays whole. Documents without words are not in it."""
    common.bounded_batches(spark)
    return mixing.mixed_documents(docs, block_words=MIX_BLOCK)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot (columns of these names are replaced)."""
    return shards.shuffle(docs)


STAGES = [("language ID", language), ("near-dedup", near_dedup), ("decontamination", decontaminate), ("mixing", mix), ("sharding", shard)]

ORACLE_SQL = None     # learned profiles and seeded draws are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
