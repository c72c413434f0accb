"""Pipeline run log.

The log is an append-only Parquet table of *records*: a start record when a
run begins and an end record when it finishes. The current state of a run is
the merge of its records (``run_state``): fields of the start record, then
status / end / counts of the latest record. Appending is idempotent under task
retries (one small file per call) and needs no in-place UPDATE. Every so many files are
folded into a snapshot (``compact``).
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.schemas import RUN_STATUSES
from squall.session import fs_path

RECORDS = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("pipeline_name", T.StringType(), True),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("row_count", T.IntegerType(), True),
    T.StructField("triggered_by", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("recorded_at", T.TimestampType(), False),
    T.StructField("seq", T.IntegerType(), False),
])

# Column defaults of the run table.
DEFAULT_STATUS = "running"
DEFAULT_TRIGGER = "manual"
DEFAULT_ROW_COUNT = 0


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


SNAPSHOT_AFTER = 64      # record files that a reader opens, about


def _append(spark: SparkSession, path: str, row: tuple) -> None:
    spark.createDataFrame([row], RECORDS).coalesce(1).write.mode("append").parquet(path)


def log_run_start(spark: SparkSession, path: str, pipeline_name: str,
                  triggered_by: str = DEFAULT_TRIGGER) -> str:
    """Append a start record; returns the new run id."""
    run_id = str(uuid.uuid4())
    compact(spark, path)
    now = _now()
    _append(spark, path, (run_id, pipeline_name, now, None, DEFAULT_STATUS, None,
                          triggered_by, None, now, 0))
    return run_id


def log_run_end(spark: SparkSession, path: str, run_id: str, status: str,
                row_count: int = DEFAULT_ROW_COUNT, error_message: str | None = None) -> _dt.timedelta | None:
    """Append an end record; returns the run's duration."""
    if status not in RUN_STATUSES:
        raise ValueError(f"status must be one of {RUN_STATUSES}")
    now = _now()
    _append(spark, path, (run_id, None, None, now, status, row_count, None, error_message, now, 1))
    state = run_state(spark.read.schema(RECORDS).parquet(path)).filter(F.col("run_id") == run_id)
    row = state.select("duration").first()
    return row["duration"] if row else None


def compact(spark: SparkSession, path: str, after: int = SNAPSHOT_AFTER) -> bool:
    """Fold the log's files into one snapshot once there are more than ``after``; whether it did.

    A run's records become at most two, its first and its latest. The snapshot is added, then the
    files it was made from are deleted; what is appended meanwhile stays, and a driver that dies
    between leaves records twice, which a run's state does not see. So a reader opens the snapshot
    and a tail of at most ``after`` files.
    """
    fs, root = fs_path(spark, path)
    if not fs.exists(root):
        return False
    files = [f.getPath().toString() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-")]
    if len(files) <= after:
        return False
    records = spark.read.schema(RECORDS).parquet(*files)
    order, whole = F.struct("seq", "recorded_at"), F.struct(*RECORDS.fieldNames())
    ends = records.groupBy("run_id").agg(F.min_by(whole, order).alias("first"), F.max_by(whole, order).alias("last"))
    folded = ends.select(F.explode(F.array_distinct(F.array("first", "last"))).alias("r")).select("r.*")
    folded.write.mode("append").parquet(path)
    for f in files:
        fs.delete(fs_path(spark, f)[1], False)
    spark.catalog.refreshByPath(path)
    return True


@contextlib.contextmanager
def run_logged(spark: SparkSession, path: str, pipeline_name: str,
               triggered_by: str = DEFAULT_TRIGGER):
    """Run a block under the log: success with its row count, or failure with
    the error (which is re-raised) (D7). The block sets ``ctx['row_count']`` (rows stored, also by a run
    that then fails) and may set ``ctx['message']`` (what a successful run has to tell)."""
    run_id = log_run_start(spark, path, pipeline_name, triggered_by)
    ctx = {"run_id": run_id, "row_count": DEFAULT_ROW_COUNT, "message": None}
    try:
        yield ctx
    except Exception as e:
        log_run_end(spark, path, run_id, "failure", row_count=int(ctx["row_count"]), error_message=str(e))
        raise
    log_run_end(spark, path, run_id, "success", row_count=int(ctx["row_count"]), error_message=ctx["message"])


def run_state(records: DataFrame) -> DataFrame:
    """Current state per run from its records (F8, X27): one keyed aggregate."""
    order = F.struct(F.col("seq"), F.col("recorded_at"))
    first = F.struct("pipeline_name", "start_time", "triggered_by")
    last = F.struct("end_time", "status", "row_count", "error_message")
    s = (records.groupBy("run_id")
         .agg(F.min_by(first, order).alias("f"), F.max_by(last, order).alias("l")))
    out = s.select(
        "run_id", "f.pipeline_name", "f.start_time", "l.end_time",
        (F.col("l.end_time") - F.col("f.start_time")).alias("duration"),
        F.coalesce(F.col("l.status"), F.lit(DEFAULT_STATUS)).alias("status"),
        "l.row_count",
        F.coalesce(F.col("f.triggered_by"), F.lit(DEFAULT_TRIGGER)).alias("triggered_by"),
        "l.error_message")
    return out


def duration_seconds(state: DataFrame) -> DataFrame:
    return state.withColumn(
        "duration_s", F.unix_seconds("end_time") - F.unix_seconds("start_time"))


def run_summary(state: DataFrame) -> DataFrame:
    """Runs per pipeline by status, rows loaded by successful runs, durations."""
    s = duration_seconds(state)
    return s.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("status") == "success").alias("n_success"),
        F.count_if(F.col("status") == "failure").alias("n_failure"),
        F.count_if(F.col("status") == "running").alias("n_running"),
        F.sum(F.when(F.col("status") == "success", F.col("row_count"))).alias("rows_success"),
        F.sum("duration_s").alias("total_duration_s"),
        F.max("duration_s").alias("max_duration_s"))


def latest_runs(state: DataFrame) -> DataFrame:
    """Latest run per pipeline (O4): the ``(pipeline_name, start_time DESC)`` access path.

    ``max_by`` over (start_time, run_id) instead of a ranking window: the
    aggregate is folded map-side, so a pipeline that owns most runs never sends
    all of them to one task.
    """
    s = duration_seconds(state)
    rest = [c for c in s.columns if c != "pipeline_name"]
    top = s.groupBy("pipeline_name").agg(
        F.max_by(F.struct(*rest), F.struct("start_time", "run_id")).alias("__r"))
    return top.select("pipeline_name", *[F.col(f"__r.{c}").alias(c) for c in rest])
