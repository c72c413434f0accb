"""One ordered CSV file, written by many tasks (K8).

``write_csv(single_file=True)`` sends all rows through one task. Here the rows are sorted
over all tasks by one range exchange, every task writes its part, and the parts are laid
one after the other into one file: each part's offset is the sum of the lengths before it,
and tasks copy pieces of bounded size to their place. A piece that is copied twice (a lost
executor, a speculative task) writes the same bytes to the same place. The file appears under its
name only when all its bytes are there.

Rows are ordered by the given columns (NULL first), then by the text of all columns from left
to right, so the bytes do not depend on the partitioning: rows that tie in both are the
same line. Without order columns the text alone decides. No rows: the header line.

Writing at an offset needs a folder that all executors mount (a ``file:`` path); object stores
have no such write, and there ``write_csv`` writes the parts.

``read_csv_file`` reads such a file with many tasks. A line break inside quotes ends no record, and a
task cannot tell so from its own piece: a first pass counts each piece's quotes, and the count before
a piece tells whether it begins inside quotes. A record belongs to the piece that it begins in.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.export import CSV_FORMAT, csv_writer, parsed_columns, text_columns
from squall.session import ensure_utc, fs_path

PIECE = 64 << 20      # bytes that one row of the copying job stands for
BUFFER = 1 << 20      # bytes that a task holds


def sorted_text(df: DataFrame, order: list[str], day_columns: tuple[str, ...]) -> DataFrame:
    """The rows as CSV text, sorted over all partitions."""
    ensure_utc(df.sparkSession)
    by = F.struct(*[F.col(f"`{c}`") for c in order]) if order else F.lit(0)
    return (df.select(by.alias("by"), F.struct(*text_columns(df, day_columns)).alias("line"))
            .orderBy("by", "line").select("line.*"))


def parts_of(spark: SparkSession, folder: str, first: int = 0) -> DataFrame:
    """(path, length, at): the part files of a folder in their order, and where each begins."""
    files = (spark.read.format("binaryFile").load(folder).select("path", "length")
             .withColumn("task", F.regexp_extract("path", r"part-(\d+)-[^/]*$", 1).cast("long"))
             .withColumn("file", F.regexp_extract("path", r"-c(\d+)[^/]*$", 1).cast("long")))
    before = Window.orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "length", (F.coalesce(F.sum("length").over(before), F.lit(0)) + first).alias("at"))


def _copier(target: str):
    """Copies pieces of part files to their places; the target must be there already."""
    def copy(frames):
        to = os.open(target, os.O_WRONLY)
        try:
            for frame in frames:
                for path, start, stop, at in frame[["path", "start", "stop", "at"]].itertuples(index=False):
                    with open(local_path(path), "rb") as part:
                        part.seek(start)
                        done = start
                        while done < stop:
                            some = part.read(min(BUFFER, stop - done))
                            if not some:
                                raise OSError(f"{path} ends at {done}, not at {stop}")
                            view = memoryview(some)
                            while view:
                                n = os.pwrite(to, view, at + done)
                                view, done = view[n:], done + n
                    yield pd.DataFrame({"n": [stop - start]})
            os.fsync(to)
        finally:
            os.close(to)

    return copy


def local_path(path: str) -> str:
    """The path of a ``file:`` address."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _mounted(spark: SparkSession, path: str):
    """The file system, and the path as the tasks open it."""
    fs, hpath = fs_path(spark, path)
    if fs.getUri().getScheme() != "file":
        raise ValueError("one file needs a mounted folder (file:); write_csv writes parts to any store")
    return fs, local_path(fs.makeQualified(hpath).toUri().getPath())


def write_csv_file(df: DataFrame, path: str, order: list[str] | None = None,
                   day_columns: tuple[str, ...] = ("occ_date_day",), piece: int = PIECE) -> int:
    """Write the rows as one ordered CSV file with a header line; returns its length in bytes.

    A file of that name is replaced. The parts lie in a hidden folder beside the file until
    the file is whole; a failed run leaves the old file as it was.
    """
    spark = df.sparkSession
    fs, final = _mounted(spark, path)
    folder, name = os.path.split(final)
    os.makedirs(folder, exist_ok=True)
    run = uuid.uuid4().hex[:12]
    work = f"{folder}/.{name}.{run}.parts"
    whole = f"{folder}/.{name}.{run}"
    try:
        csv_writer(spark.createDataFrame([tuple(df.columns)], [f"c{i}" for i in range(len(df.columns))]).coalesce(1)).csv(f"file:{work}/header")
        csv_writer(sorted_text(df, order or [], day_columns)).csv(f"file:{work}/rows")
        header = parts_of(spark, f"file:{work}/header").agg(F.sum("length")).first()[0]
        parts = parts_of(spark, f"file:{work}/header").unionByName(parts_of(spark, f"file:{work}/rows", header)).where("length > 0")
        pieces = (parts.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(piece).cast("long"))))
                  .select("path", "start", F.least(F.col("start") + piece, "length").alias("stop"), "at"))
        with open(whole, "xb"):
            pass
        # By a fixed count: AQE would put these few short rows, which name many bytes, into one task.
        copied = pieces.repartition(max(1, pieces.count())).mapInPandas(_copier(whole), "n long").agg(F.sum("n")).first()[0]
        if copied != os.path.getsize(whole):
            raise OSError(f"{copied} bytes copied, {os.path.getsize(whole)} in the file")
        os.replace(whole, final)
    finally:
        if os.path.exists(whole):
            os.remove(whole)
        fs.delete(fs_path(spark, f"file:{work}")[1], True)
    checksum = f"{folder}/.{name}.crc"          # of a file that Hadoop's local writer left under this name
    if os.path.exists(checksum):
        os.remove(checksum)
    return copied


def _quote_counter(path: str):
    """Counts the quotes of pieces of the file."""
    def count(frames):
        with open(path, "rb") as file:
            for frame in frames:
                for start, stop in frame[["start", "stop"]].itertuples(index=False):
                    file.seek(start)
                    at, n = start, 0
                    while at < stop:
                        some = file.read(min(BUFFER, stop - at))
                        if not some:
                            raise OSError(f"{path} ends at {at}, not at {stop}")
                        at, n = at + len(some), n + some.count(b'"')
                    yield pd.DataFrame({"start": [start], "stop": [stop], "quotes": [n]})

    return count


def _record_reader(path: str):
    """The records that begin in pieces of the file, without the header and their line ends."""
    def records(file, start: int, stop: int, quoted: bool):
        file.seek(max(start - 1, 0))
        skipping = start == 0 or file.read(1) != b"\n" or quoted      # the header, or a record of the piece before
        at, record = start, []
        while record or at < stop:
            line = file.readline()
            if not line:
                break
            at += len(line)
            quoted ^= bool(line.count(b'"') & 1)
            if skipping:
                skipping = quoted
                continue
            record.append(line)
            if not quoted:
                yield b"".join(record).removesuffix(b"\n").decode()
                record = []
        if record:
            raise ValueError(f"{path} ends inside quotes")

    def read(frames):
        with open(path, "rb") as file:
            for frame in frames:
                for start, stop, quoted in frame[["start", "stop", "quoted"]].itertuples(index=False):
                    held, size = [], 0
                    for text in records(file, start, stop, bool(quoted)):
                        held.append(text)
                        size += len(text)
                        if size >= BUFFER:
                            yield pd.DataFrame({"value": held})
                            held, size = [], 0
                    yield pd.DataFrame({"value": pd.Series(held, dtype=object)})

    return read


def read_csv_file(spark: SparkSession, path: str, schema: T.StructType, day_columns: tuple[str, ...] = ("occ_date_day",),
                  piece: int = PIECE) -> DataFrame:
    """What ``read_csv`` gives for a file of ``write_csv_file``, read by a task for each ``piece`` bytes."""
    _, final = _mounted(spark, path)
    size = os.path.getsize(final)
    count = max(1, -(-size // piece))
    pieces = spark.range(0, size, piece, count).select(F.col("id").alias("start"), F.least(F.col("id") + piece, F.lit(size)).alias("stop"))
    before = Window.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)        # a row for each piece
    placed = (pieces.mapInPandas(_quote_counter(final), "start long, stop long, quotes long")
              .select("start", "stop", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("quoted")))
    lines = placed.repartition(count).mapInPandas(_record_reader(final), "value string").where("value <> ''")
    names = ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema.fields)
    row = F.from_csv("value", names, {k: str(v) for k, v in CSV_FORMAT.items()})
    return lines.select(row.alias("row")).select("row.*").select(*parsed_columns(schema, day_columns))
