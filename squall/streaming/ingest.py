"""Incremental incident ingest with Structured Streaming.

New landed day files are read as a file stream, each micro-batch is
normalised with the batch code and upserted into the ``raw_incidents`` table
(``foreachBatch``), and progress is kept in a checkpoint in the shared folder.
The table stores each row's order (landing number, landing day, page, position), and
versions compete by that order: what was landed later wins, also for a day that is fetched
again, and replays after a failure or files read out of order leave the same table.
The table is partitioned by occurrence month (``occ_month``, ``yyyy-MM``,
NULL when undated): a micro-batch rewrites only the months its rows go to and
the months its keys are found in now (a narrow key/partition scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from squall.operators import runlog
from squall.operators.commit import PARTITIONING, STREAM_TABLE, commit_landed, upsert_batch  # noqa: F401
from squall.schemas import RAW_INCIDENTS
from squall.session import ensure_utc
from squall.sources.landed import parsed_documents, with_source

LANDED_TEXT = T.StructType([
    T.StructField("value", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("month", T.IntegerType(), True),
    T.StructField("day", T.IntegerType(), True),
])


def start_incident_stream(spark: SparkSession, landed_path: str, table_path: str,
                          checkpoint_path: str, files_per_trigger: int = 1,
                          available_now: bool = True, lenient: bool = False, strict: bool = False,
                          wholetext: bool = False, run_log_path: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what has landed and stops.

    Each micro-batch is committed as the batch job does it: its good days are stored, a day with a
    bad row is not, and bad rows and rejected documents go to the table's dead letters under the
    batch's number, so a replay replaces them (``commit.read_dead_letters``). ``strict`` stops the
    stream at a rejected document instead. With ``run_log_path`` every micro-batch is a run of the
    log, triggered by the batch. ``wholetext`` for files that hold one document
    over several lines.
    """
    ensure_utc(spark)
    lines = (spark.readStream.schema(LANDED_TEXT)
             .option("maxFilesPerTrigger", files_per_trigger).text(landed_path, wholetext=wholetext))
    parsed = parsed_documents(with_source(lines, F.make_date("year", "month", "day")))

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        session, name = batch.sparkSession, f"stream-{epoch_id:09d}"
        if run_log_path is None:
            commit_landed(session, batch, table_path, name, lenient, strict)
            return
        with runlog.run_logged(session, run_log_path, "tps_stream", name) as ctx:
            done = commit_landed(session, batch, table_path, name, lenient, strict)
            ctx["row_count"], ctx["message"] = done.rows_upserted, done.message()

    writer = (parsed.writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint_path))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_table(spark: SparkSession, table_path: str) -> DataFrame:
    """The stream's target as ``raw_incidents`` (order and partition columns dropped)."""
    return spark.read.schema(STREAM_TABLE).parquet(table_path).select(
        *[f.name for f in RAW_INCIDENTS.fields])
