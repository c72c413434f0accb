"""Helpers shared by the training-data operators: tables, scratch, numbering, components."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.session import fs_path, scratch_path

LOW = "abcdefghijklmnopqrstuvwxyz"
BATCH_BYTES = 8 << 20
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold at most ``BATCH_BYTES``: a Python task holds a few of them, whatever its rows are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) != f"{BATCH_BYTES}b":
        spark.conf.set(name, f"{BATCH_BYTES}b")


def marked(docs: DataFrame, name: str) -> DataFrame:
    """The rows as (row, doc): a stored number that tells rows apart, equal ones too, and all columns in one struct."""
    columns = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), columns.alias("doc")), name)


_PASSING: list[list[str]] = []


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Delete at the end of the block what ``stored`` wrote in it, but for what it was told to keep."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in _PASSING.pop():
            fs, place = fs_path(spark, path)
            fs.delete(place, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage: a lost executor costs the tasks it ran, not the steps before.
    """
    path = scratch_path(df.sparkSession, name)
    if _PASSING and not keep:
        _PASSING[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def numbered(df: DataFrame, order: list[Column], name: str, out: str = "row_number") -> tuple[DataFrame, int]:
    """Give every row its 0-based position in the total order ``order``; also the row count.

    Rows are range-partitioned and sorted by many tasks; a partition's first number is
    the count of the rows before it. Only one count for each partition reaches the
    driver. Rows that tie in ``order`` follow each other in either order, and are dealt over
    several tasks if they are many.
    """
    spark = df.sparkSession
    placed = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order, "__tie").sortWithinPartitions(*order).drop("__tie")
    placed = stored(placed.withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright("__at", 33)
    counts = sorted((r[0], r[1]) for r in placed.groupBy(part).count().collect())
    first, total = [], 0
    for p, n in counts:
        first.append((p, total))
        total += n
    starts = spark.createDataFrame(first, "__part long, __first long")
    out_df = (placed.withColumn("__part", part)
              .join(F.broadcast(starts), "__part")
              .withColumn(out, F.col("__first") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)))
              .drop("__part", "__first", "__at"))
    return out_df, total


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the undirected ``edges`` (u, v): one row (node, component).

    ``component`` is the smallest node reachable. Alternates large-star and small-star
    steps (each hangs neighbours on the smallest known node) until nothing changes;
    every step is a minimum per node and a join, so a node with millions of
    neighbours is folded before the shuffle and its join can be split. Nodes
    without an edge to another node are not listed.
    """
    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        # Stored, so that the join below reads two plain shuffles and a hot node's one can be split.
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        least = stored(least.select("u", F.least("u", "m").alias("m")), f"{name}-least")
        both = pairs.join(least, "u")
        if larger:
            return both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = both.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return hung.unionByName(least.select("u", F.col("m").alias("v")))

    def measure(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .distinct(), f"{name}-edges")
    was = measure(now)
    while was[0]:
        both_ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both_ways, True).where("u <> v").distinct()
        now = stored(star(large, False).where("u <> v").distinct(), f"{name}-edges")
        got = measure(now)
        if got == was:
            break
        was = got
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
