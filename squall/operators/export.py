"""CSV export of the mart and its read-back.

The reference pulls the whole mart into one pandas frame in one process and
writes one file. Here every task writes its own part file; one file is only
produced when asked: ``single_file=True`` funnels all rows through one task,
``onefile.write_csv_file`` sorts and writes with all tasks. Values are formatted as the reference's files show them: booleans
``True``/``False``, NULL as an empty field, instants as
``YYYY-MM-DD HH:MM:SS+00:00`` (UTC session), zone-less day starts as ``YYYY-MM-DD``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from squall.session import ensure_utc

INSTANT_FORMAT = "yyyy-MM-dd HH:mm:ssxxx"
INSTANT_FORMAT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSSxxx"
WALLCLOCK_FORMAT = "yyyy-MM-dd HH:mm:ss"
WALLCLOCK_FORMAT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DAY_FORMAT = "yyyy-MM-dd"
# How files are read back: blank is NULL, quotes are doubled, white space is kept.
CSV_FORMAT = {"nullValue": "", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_text(df: DataFrame, day_columns: tuple[str, ...] = ("occ_date_day",)) -> DataFrame:
    """Every column rendered as the text written to the file (NULL stays NULL)."""
    ensure_utc(df.sparkSession)
    return df.select(*text_columns(df, day_columns))


def text_columns(df: DataFrame, day_columns: tuple[str, ...] = ("occ_date_day",)) -> list[Column]:
    """The columns of ``csv_text``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.BooleanType):
            c = F.when(c, "True").when(~c, "False")
        elif isinstance(t, T.TimestampType):
            c = _with_micros(c, INSTANT_FORMAT, INSTANT_FORMAT_MICROS)
        elif isinstance(t, T.TimestampNTZType):
            c = (F.date_format(c, DAY_FORMAT) if f.name in day_columns
                 else _with_micros(c, WALLCLOCK_FORMAT, WALLCLOCK_FORMAT_MICROS))
        elif isinstance(t, T.DateType):
            c = F.date_format(c, DAY_FORMAT)
        elif isinstance(t, T.FloatType):
            c = _plain_float(c)
        elif isinstance(t, T.DecimalType):
            c = c.cast("double").cast("string")
        else:
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return cols


def _plain_float(c):
    """Shortest text of a 32-bit number, without an exponent (``0.1``, ``0.0004``, ``12.0``)."""
    text = c.cast("string")
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    return F.when(F.contains(text, F.lit("E")), F.coalesce(plain, text)).otherwise(text)


def _with_micros(c, plain: str, micros: str):
    """Whole seconds as ``plain``; a fraction, when present, as microseconds."""
    frac = F.unix_micros(c.cast("timestamp")) % 1_000_000
    return F.when(frac == 0, F.date_format(c, plain)).otherwise(F.date_format(c, micros))


def write_csv(df: DataFrame, path: str, single_file: bool = False,
              day_columns: tuple[str, ...] = ("occ_date_day",)) -> None:
    """Header + rows; a directory of part files (one file if ``single_file``)."""
    out = csv_text(df, day_columns)
    if single_file:
        out = out.coalesce(1)
    csv_writer(out).mode("overwrite").option("header", True).csv(path)


def csv_writer(text: DataFrame) -> DataFrameWriter:
    """The writer of all exports: blank for NULL, quotes doubled, white space kept."""
    return (text.write.option("nullValue", "").option("emptyValue", "")
            .option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             day_columns: tuple[str, ...] = ("occ_date_day",), multiline: bool = True) -> DataFrame:
    """Read an exported file back with the mart's declared schema.

    Text columns are read as strings and parsed with the same formats the
    writer used, so the round trip is exact. Quoted fields may hold line breaks (one task
    a part file); ``multiline=False`` splits large files whose fields are known not to.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read.option("header", True).option("multiLine", multiline).options(**CSV_FORMAT)
           .schema(text_schema).csv(path))
    return raw.select(*parsed_columns(schema, day_columns))


def parsed_columns(schema: T.StructType, day_columns: tuple[str, ...]) -> list[Column]:
    """Typed columns of the text columns that ``csv_text`` gives."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.BooleanType):
            c = F.when(c == "True", True).when(c == "False", False)
        elif isinstance(t, T.TimestampType):
            c = F.coalesce(F.try_to_timestamp(c, F.lit(INSTANT_FORMAT)),
                           F.try_to_timestamp(c, F.lit(INSTANT_FORMAT_MICROS)))
        elif isinstance(t, T.TimestampNTZType):
            fmts = [DAY_FORMAT] if f.name in day_columns else [WALLCLOCK_FORMAT, WALLCLOCK_FORMAT_MICROS]
            c = F.coalesce(*[F.try_to_timestamp(c, F.lit(x)).cast("timestamp_ntz") for x in fmts])
        elif isinstance(t, T.DateType):
            c = F.to_date(c, DAY_FORMAT)
        else:
            c = c.cast(t)
        cols.append(c.alias(f.name))
    return cols
