"""Committing landed incidents, with the local day as the unit that is stored or fails.

A batch of landed documents is read once: normalised rows go to a staging folder, and documents
and rejects are counted by metrics observed on that write. What the strict reading of a row would
raise on is a column there (``fault``), so one narrow aggregate of the staging folder tells each day's
rows and faults. Days without a fault are merged into the table in one upsert; a day with a bad row
is stored not at all, as if it had been rolled back, and does not touch the others. Each day's
outcome is a record of the day log, and bad rows and rejected documents go to the dead letters, under
the name of the run or micro-batch, so that a replay replaces what it wrote before.

The only data on the driver are the failed days (a day each) and counts.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.ingest import ORDER_COLUMNS, normalise_incidents
from squall.operators.upsert import remove, table_exists, upsert_table
from squall.schemas import RAW_INCIDENTS
from squall.session import ensure_utc, scratch_path
from squall.sources.landed import REASONS, documents_to_features

STREAM_TABLE = T.StructType(list(RAW_INCIDENTS.fields) + [
    T.StructField("doc_day", T.DateType(), True),
    T.StructField("page", T.IntegerType(), True),
    T.StructField("pos", T.LongType(), True),
    T.StructField("landed_at", T.LongType(), True),
    T.StructField("occ_month", T.StringType(), True),
])
PARTITIONING = ["occ_month"]

DAY_RECORDS = T.StructType([
    T.StructField("doc_day", T.DateType(), True),
    T.StructField("status", T.StringType(), False),       # stored or failed
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("n_bad", T.LongType(), False),
    T.StructField("reason", T.StringType(), True),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("recorded_at", T.TimestampType(), False),
])
DEAD_LETTERS = "doc_day date, doc_path string, page int, pos long, event_id string, reason string, raw string"


class RejectedDocuments(ValueError):
    """Landed documents that could not be read, in strict mode."""


@dataclass
class Outcome:
    """What a batch came to: counts of the upsert, rejected documents by reason, failed days."""

    rows_upserted: int = 0
    distinct_keys: int = 0
    null_keys: int = 0
    rejects: dict[str, int] = field(default_factory=dict)
    failed: list[tuple[_dt.date, int, str]] = field(default_factory=list)

    def message(self) -> str | None:
        """One line on what was not stored, or None."""
        said = []
        if self.rejects:
            said.append("rejected documents: " + ", ".join(f"{n} {reason}" for reason, n in sorted(self.rejects.items())))
        if self.failed:
            said.append("failed days: " + ", ".join(f"{day} ({n} rows, {reason})" for day, n, reason in self.failed))
        if self.null_keys:
            said.append(f"rows without key: {self.null_keys}")
        return "; ".join(said) or None


def day_log(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.days"


def dead_letters(table_path: str) -> str:
    return f"{table_path.rstrip('/')}.rejected"


def read_days(spark: SparkSession, table_path: str) -> DataFrame:
    """The latest record of each landing day (``doc_day, status, n_rows, n_bad, reason, run_id``)."""
    if not table_exists(spark, day_log(table_path)):
        return spark.createDataFrame([], DAY_RECORDS).drop("recorded_at")
    rest = F.struct("status", "n_rows", "n_bad", "reason", "run_id")
    return (spark.read.schema(DAY_RECORDS).parquet(day_log(table_path)).groupBy("doc_day")
            .agg(F.max_by(rest, F.struct("recorded_at", "run_id")).alias("last")).select("doc_day", "last.*"))


def open_days(spark: SparkSession, table_path: str) -> list[_dt.date]:
    """Days whose latest outcome is a failure: an incremental run reads them again."""
    return sorted(r["doc_day"] for r in read_days(spark, table_path).where("status = 'failed' AND doc_day IS NOT NULL").select("doc_day").collect())


def read_dead_letters(spark: SparkSession, table_path: str) -> DataFrame:
    """What was not stored: rejected documents (with their path) and bad rows (with their payload), by ``batch``."""
    schema = T.StructType([*T._parse_datatype_string(DEAD_LETTERS).fields, T.StructField("batch", T.StringType())])
    if not table_exists(spark, dead_letters(table_path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(dead_letters(table_path))


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"occ_month": F.date_format("occ_date_utc", "yyyy-MM"), "pos": F.col("pos").cast("bigint")})


def upsert_batch(spark: SparkSession, table_path: str, features: DataFrame, lenient: bool = False) -> DataFrame:
    """Normalise one batch of features and upsert it into the table; a bad value fails the whole batch."""
    ensure_utc(spark)
    return _upsert(spark, table_path, _with_month(normalise_incidents(features, lenient=lenient)))


def _upsert(spark: SparkSession, table_path: str, rows: DataFrame, staged: bool = False) -> DataFrame:
    return upsert_table(spark, table_path, rows, STREAM_TABLE, ["event_id"], list(ORDER_COLUMNS),
                        PARTITIONING, preserve=("inserted_at",), order_in_target=True,
                        partition_follows_key=False, staged=staged)


def commit_landed(spark: SparkSession, parsed: DataFrame, table_path: str, batch_id: str, lenient: bool = False,
                  strict: bool = False) -> Outcome:
    """Store the good days of ``parsed`` documents; ``strict`` fails on a rejected document before anything is stored."""
    ensure_utc(spark)
    documents = Observation()
    watched = parsed.observe(documents, *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS])
    rows = _with_month(normalise_incidents(documents_to_features(watched), lenient=lenient, faults=not lenient))
    if lenient:
        rows = rows.withColumn("fault", F.lit(None).cast("string"))
    folder = scratch_path(spark, "landed-batch")
    try:
        rows.write.parquet(folder)
        rows = spark.read.schema(rows.schema).parquet(folder)
        out = Outcome(rejects={r: n for r, n in documents.get.items() if n})
        if strict and out.rejects:
            raise RejectedDocuments(out.message())
        days = rows.groupBy("doc_day").agg(F.count("*").alias("n_rows"), F.count("fault").alias("n_bad"), F.min("fault").alias("reason"))
        out.failed = sorted(((r["doc_day"], r["n_bad"], r["reason"]) for r in days.where("n_bad > 0").collect()), key=str)
        if out.rejects or out.failed:
            _write_dead(spark, parsed, rows, out, table_path, batch_id)
        good = rows.drop("fault")
        if out.failed:
            bad = spark.createDataFrame([(d,) for d, _, _ in out.failed], "bad_day date")
            good = good.join(F.broadcast(bad), F.col("doc_day").eqNullSafe(F.col("bad_day")), "left_anti")
        counts = _upsert(spark, table_path, good, staged=True).first()
        out.rows_upserted, out.distinct_keys, out.null_keys = counts
        (days.select("doc_day", F.when(F.col("n_bad") > 0, "failed").otherwise("stored").alias("status"), "n_rows", "n_bad", "reason",
                     F.lit(batch_id).alias("run_id"), F.lit(_dt.datetime.now(_dt.timezone.utc)).alias("recorded_at"))
         .coalesce(1).write.mode("append").parquet(day_log(table_path)))       # a row for each calendar day
        return out
    finally:
        remove(spark, folder)


def _write_dead(spark: SparkSession, parsed: DataFrame, rows: DataFrame, out: Outcome, table_path: str, batch_id: str) -> None:
    """Bad rows and, where there are any, rejected documents (only then the documents are read again)."""
    none = {n: F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in DEAD_LETTERS.split(", "))}
    dead = rows.where("fault is not null").select("doc_day", none["doc_path"], "page", "pos", "event_id", F.col("fault").alias("reason"),
                                                  F.to_json("raw").alias("raw"))
    if out.rejects:
        documents = parsed.where("reason is not null")
        dead = dead.unionByName(documents.select("doc_day", "doc_path", none["page"], none["pos"], none["event_id"], "reason", none["raw"]))
    dead.write.mode("overwrite").parquet(f"{dead_letters(table_path)}/batch={batch_id}")
