"""Landed API documents: writers (K1) and readers.

Incident pages land as one JSON document per line under Hive-style
``year=YYYY/month=MM/day=DD`` directories (the reference's raw landing zone).
Weather documents carry the requested grid point and land in one folder for each landing,
``load=<number>``, in files whose number follows the bytes, not the points and days; a folder
is finished when its ``_SUCCESS`` mark is there. Documents of other origin under
``lat=<lat>/lon=<lon>`` directories are read too, with the grid point of the path.

Readers are line-oriented (splittable, one task per file split); a document
that spans lines can be read with ``wholetext=True`` (one task per file).
Partition columns are plain filters, so a day range prunes directories.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.functions import geo
from squall.functions import timeutil as tu
from squall.schemas import INCIDENT_DOCUMENT_DDL, LAT_LON_CACHE, WEATHER_DOCUMENT, WEATHER_VARIABLES
from squall.session import ensure_utc, fs_path

WEATHER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
DOC_SIZE = 1000
REASONS = ("unparsable", "no features")
WEATHER_REASONS = ("unparsable", "no hours", "no grid point")


# --- incidents -------------------------------------------------------------------

def _load_number(load: int | None) -> int:
    """Number of a landing: epoch milliseconds of its start, so a later landing is greater."""
    return int(time.time() * 1000) if load is None else load


def land_incident_documents(features: DataFrame, path: str, load: int | None = None, cut=None) -> None:
    """Write features ``(doc_day, page, pos, feature)`` as documents of at
    most ``DOC_SIZE`` features, one group per (local day, page, pos / DOC_SIZE),
    replacing only the days written (K1).

    Every collect is bounded by ``DOC_SIZE`` whatever the input, and a hot day
    spreads over many groups. Order inside a document is restored with
    ``array_sort`` on the position; the reader rebuilds the position as
    ``chunk * DOC_SIZE + index``, which keeps the order of the input. All documents of
    one call carry its ``load`` number (default: now): versions of a key compete by it first.

    ``cut`` (a boolean Column over doc_day, page, chunk) truncates matching documents, to
    exercise the reader's account of rejected ones.
    """
    ensure_utc(features.sparkSession)
    items = F.struct(F.col("pos"), F.to_json("feature").alias("js"))
    chunk = F.call_function("div", F.col("pos"), F.lit(DOC_SIZE)).cast("int")
    docs = (features.groupBy("doc_day", "page", chunk.alias("chunk"))
            .agg(F.array_sort(F.collect_list(items)).alias("items")))
    text = F.concat(F.lit(f'{{"load":{_load_number(load)},"page":'), F.col("page").cast("string"),
                    F.lit(',"chunk":'), F.col("chunk").cast("string"), F.lit(',"features":['),
                    F.array_join(F.transform("items", lambda x: x["js"]), ","), F.lit("]}"))
    if cut is not None:
        text = F.when(cut, F.substring(text, 1, 40)).otherwise(text)
    # A file for each day, more only where a day is large: as many as the bytes ask for, not tasks times days.
    (docs.select(text.alias("value"),
                 F.date_format("doc_day", "yyyy").alias("year"),
                 F.date_format("doc_day", "MM").alias("month"),
                 F.date_format("doc_day", "dd").alias("day"))
     .hint("rebalance", "year", "month", "day")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("year", "month", "day").text(path))


def read_landed_text(spark: SparkSession, path: str, start_day: str | None = None, end_day: str | None = None,
                     wholetext: bool = False, also: list | None = None) -> DataFrame:
    """Landed lines (or whole files) with ``doc_day``, ``doc_path`` and the file's ``modified`` time.

    ``start_day`` / ``end_day`` (inclusive local days) prune the ``year/month/day`` directories
    before any file is opened; the days in ``also`` are read although they lie before ``start_day``.
    """
    ensure_utc(spark)
    raw = spark.read.text(path, wholetext=wholetext)
    day = F.make_date("year", "month", "day")
    if start_day is not None:
        late = day >= F.lit(start_day).cast("date")
        raw = raw.filter(late | day.isin(*also) if also else late)
    if end_day is not None:
        raw = raw.filter(day <= F.lit(end_day).cast("date"))
    return with_source(raw, day)


def with_source(raw: DataFrame, day) -> DataFrame:
    return raw.select("value", day.alias("doc_day"), F.col("_metadata.file_path").alias("doc_path"),
                      F.unix_millis("_metadata.file_modification_time").alias("modified"))


def parsed_documents(raw: DataFrame) -> DataFrame:
    """Documents with ``reason``: why one is not accepted (NULL if it is). Blank lines are no documents.

    ``landed_at`` is the landing's number, or the file's modification time where a document has none.
    """
    schema = T.StructType([*T._parse_datatype_string(INCIDENT_DOCUMENT_DDL).fields, T.StructField("load", T.LongType()),
                           T.StructField("_corrupt", T.StringType())])
    doc = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"})
    reason = (F.when(F.col("doc").isNull() | F.col("doc._corrupt").isNotNull(), "unparsable")
              .when(F.col("doc.features").isNull(), "no features"))
    return (raw.where(F.trim("value") != "").withColumn("doc", doc)
            .select("doc_day", "doc_path", F.coalesce("doc.load", "modified").alias("landed_at"), reason.alias("reason"), "doc"))


def read_incident_documents(spark: SparkSession, path: str, start_day: str | None = None,
                            end_day: str | None = None, wholetext: bool = False) -> DataFrame:
    """Features of the accepted documents: ``(landed_at, doc_day, page, pos, feature VARIANT)``.

    ``document_account`` tells what was not accepted.
    """
    return documents_to_features(parsed_documents(read_landed_text(spark, path, start_day, end_day, wholetext)))


def documents_to_features(parsed: DataFrame) -> DataFrame:
    """Documents -> features in source order: ``pos`` is the position in the
    page (``chunk * DOC_SIZE + index`` for documents split by the writer)."""
    exploded = parsed.where(F.col("reason").isNull()).select(
        "landed_at", "doc_day", F.coalesce(F.col("doc.page"), F.lit(0)).alias("page"),
        F.coalesce(F.col("doc.chunk"), F.lit(0)).alias("chunk"), F.posexplode("doc.features").alias("idx", "feature"))
    return exploded.select("landed_at", "doc_day", "page",
                           (F.col("chunk").cast("bigint") * DOC_SIZE + F.col("idx")).alias("pos"), "feature")


def document_account(parsed: DataFrame) -> DataFrame:
    """Per landing day: accepted and rejected documents, by reason."""
    return (parsed.groupBy("doc_day")
            .agg(F.count_if(F.col("reason").isNull()).alias("n_accepted"),
                 F.count_if(F.col("reason") == "unparsable").alias("n_unparsable"),
                 F.count_if(F.col("reason") == "no features").alias("n_no_features")))


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """The documents that were not accepted: day, file and reason."""
    return parsed.where(F.col("reason").isNotNull()).select("doc_day", "doc_path", "reason")


# --- weather ---------------------------------------------------------------------

def land_weather_documents(hours: DataFrame, path: str, bad_time=None, load: int | None = None) -> None:
    """Write cache-shaped hourly rows as the weather documents of one landing, one per (grid point,
    UTC day): parallel arrays ordered by hour (at most 24 entries each), with the grid point.

    A landing is a folder of its own (landed again under the same ``load`` number it is replaced); later
    landings win hour by hour, so nothing that was landed before is touched. Its files are as many as
    the shuffle's byte target makes them.

    ``bad_time`` (a boolean Column) replaces the time text of matching rows
    with a malformed value, to exercise the reader's row-dropping rule.
    """
    ensure_utc(hours.sparkSession)
    t = F.date_format("hour_utc", WEATHER_TIME_FORMAT)
    if bad_time is not None:
        t = F.when(bad_time, F.lit("not-a-time")).otherwise(t)
    fields = [F.col("hour_utc"), t.alias("time")] + [
        F.col(col).cast("double").alias(key) for key, (col, _) in WEATHER_VARIABLES.items()]
    docs = (hours.groupBy("lat", "lon", "date_utc")
            .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("h")))
    def field(name):
        return F.transform("h", lambda x: x[name]).alias(name)
    hourly = F.struct(field("time"), *[field(k) for k in WEATHER_VARIABLES])
    number = _load_number(load)
    grid = [F.col(c).cast("double").cast("string").alias(c) for c in ("lat", "lon")]
    (docs.select(F.to_json(F.struct(F.lit(number).cast("bigint").alias("load"), *grid, hourly.alias("hourly"))).alias("value"))
     .write.mode("overwrite").text(f"{path.rstrip('/')}/{LANDING}{number}"))


LANDING = "load="


def _landing_folders(spark: SparkSession, path: str) -> tuple[list[int], list[str]]:
    """Numbers of the finished landings under ``path``, and the other entries there (names only)."""
    fs, root = fs_path(spark, path)
    numbers, others = [], []
    for f in fs.listStatus(root):
        name = f.getPath().getName()
        if f.isDirectory() and name.startswith(LANDING) and name[len(LANDING):].isdigit():
            if fs.exists(fs_path(spark, f"{f.getPath().toString()}/_SUCCESS")[1]):
                numbers.append(int(name[len(LANDING):]))
        elif not name.startswith(("_", ".")):
            others.append(f.getPath().toString())
    return sorted(numbers), others


def landings(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished landings."""
    return _landing_folders(spark, path)[0]


def parsed_weather_documents(spark: SparkSession, path: str, multiline: bool = False, since: int | None = None,
                             loads: list[int] | None = None) -> DataFrame:
    """Landed weather documents with their requested grid point, and ``reason`` as for incidents.

    One document per line by default (splittable); ``multiline=True`` for pretty-printed files (one
    task per file). ``since``: only documents landed after this number; ``loads``: only these landings. Of
    finished landings that are not asked for, nothing is listed or read.
    """
    ensure_utc(spark)  # document times are UTC wall clocks
    numbers, others = _landing_folders(spark, path)
    if loads is not None:
        numbers, others = [n for n in numbers if n in set(loads)], []
    elif since is not None:
        numbers = [n for n in numbers if n > since]
    text = T.StructField("value", T.StringType())
    fields = [T.StructField("load", T.LongType()), T.StructField("lat", T.StringType()), T.StructField("lon", T.StringType()),
              *WEATHER_DOCUMENT.fields, T.StructField("_corrupt", T.StringType())]
    paths = [f"{path.rstrip('/')}/{LANDING}{n}" for n in numbers] + others
    if paths:
        raw = (spark.read.schema(T.StructType([text])).option("recursiveFileLookup", "true").text(paths, wholetext=multiline)
               .select("value", F.col("_metadata.file_path").alias("doc_path"), F.unix_millis("_metadata.file_modification_time").alias("modified")))
    else:
        raw = spark.createDataFrame([], "value string, doc_path string, modified long")
    doc = F.from_json("value", T.StructType(fields), {"columnNameOfCorruptRecord": "_corrupt"})

    def point(axis: str):
        of_path = F.regexp_extract("doc_path", f"/{axis}=([^/]+)/", 1)
        return F.coalesce(F.col(f"doc.{axis}"), F.when(of_path != "", of_path)).alias(axis)

    reason = (F.when(F.col("doc").isNull() | F.col("doc._corrupt").isNotNull(), "unparsable")
              .when(F.col("doc.hourly").isNull(), "no hours")
              .when(F.expr("try_cast(lat as double) is null or try_cast(lon as double) is null"), "no grid point"))
    parsed = (raw.where(F.trim("value") != "").withColumn("doc", doc)
              .select(point("lat"), point("lon"), "doc_path", F.coalesce("doc.load", "modified").alias("landed_at"), "doc")
              .withColumn("reason", reason))
    return parsed if since is None else parsed.where(F.col("landed_at") > since)


def accepted_weather(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reason").isNull()).select("lat", "lon", F.col("doc.hourly").alias("hourly"), "doc_path", "landed_at")


def read_weather_documents(spark: SparkSession, path: str, multiline: bool = False, since: int | None = None,
                           loads: list[int] | None = None) -> DataFrame:
    """Accepted weather documents -> ``(lat, lon, hourly, doc_path, landed_at)``."""
    return accepted_weather(parsed_weather_documents(spark, path, multiline, since, loads))


def weather_hours_from_documents(docs: DataFrame) -> DataFrame:
    """Zip the parallel hourly arrays into cache rows.

    ``time`` gives the rows: a document without it has none, longer arrays are cut to it, and a
    shorter or missing one fails the job (the reference's index lookup raises). A malformed time
    drops only its row. When the documents carry where they come from, ``landed_at``,
    ``doc_path`` and the array index ``idx`` are kept as the upsert order (a later landing wins).
    """
    keys = list(WEATHER_VARIABLES)
    n = F.coalesce(F.size("hourly.time"), F.lit(0))
    n = F.when(n < 0, 0).otherwise(n)
    enough = n == 0
    for_all = None
    for k in keys:
        ok = F.coalesce(F.size(F.col(f"hourly.{k}")) >= n, F.lit(False))
        for_all = ok if for_all is None else (for_all & ok)
    checked = docs.withColumn(
        "hourly", F.when(enough | for_all, F.col("hourly")).otherwise(
            F.raise_error(F.lit("weather array shorter than its times")).cast(docs.schema["hourly"].dataType)))
    cut = [F.slice(F.col(f"hourly.{k}"), F.lit(1), n).alias(k) for k in ["time"] + keys]
    checked = checked.where(F.size("hourly.time") > 0)
    order = [c for c in ("landed_at", "doc_path") if c in docs.columns]
    rows = checked.select(
        *order,
        geo.grid_round(F.col("lat")).cast(LAT_LON_CACHE).alias("lat"),
        geo.grid_round(F.col("lon")).cast(LAT_LON_CACHE).alias("lon"),
        F.posexplode(F.arrays_zip(*cut))
         .alias("idx", "z"))
    rows = rows.withColumn("hour_utc", F.try_to_timestamp("z.time")).filter(F.col("hour_utc").isNotNull())
    return rows.select(
        "lat", "lon", "hour_utc", tu.utc_date("hour_utc").alias("date_utc"),
        *[F.col(f"z.{k}").cast(t).alias(col) for k, (col, t) in WEATHER_VARIABLES.items()],
        *order, *(["idx"] if order else []))
