"""Keyed last-wins upsert (K2, K3, J3, O5) as set operations.

``merge_last_wins`` is the pure operator: stored rows and a batch are unioned
and reduced per key with ``max_by`` / ``min_by`` over an order struct. This is
one hash-partitioned aggregate with map-side partial aggregation, so a key that
repeats many times in a batch (a hot key) is folded on the map side before the
shuffle instead of landing in one task.

``merge_files`` is the same merge over Parquet files with a wide payload, in two phases: narrow
rows (key, order, row address) are reduced to the address of each key's winner, then the winners'
rows are fetched by address. The payload is shuffled once and not sorted for the merge.

``upsert_table`` persists it: the batch is written once beside the table, only the
partitions that it touches are read and merged (an index beside the table tells where its keys
are), the merge is written once, and its partition folders are moved into place. Untouched partitions are never rewritten, and a
lost executor just reruns its tasks (no state outside files). A driver that dies in the
middle of the swap leaves a finished staging folder; the next upsert completes it first.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.operators.locator import KeyIndex
from squall.session import ensure_utc, fs_path

_SRC = "__src"
_ORD = "__ord"

_ADDRESS = ["__from", "__file", "__row"]      # stored or batch, file, row in the file

READY = "_READY"      # marks a staging folder whose files are complete


def merge_last_wins(target: DataFrame | None, batch: DataFrame, keys: list[str],
                    order: list[str], preserve: tuple[str, ...] = (),
                    columns: list[str] | None = None,
                    order_in_target: bool = False, null_keys: str = "drop") -> DataFrame:
    """Rows of ``target`` updated by ``batch``: one row per key, latest version wins.

    - ``order`` columns of ``batch`` give the sequence (last = wins); stored
      rows come before every batch row.
    - ``preserve`` columns keep the value of the first version of the key (the
      stored row's, else the first batch row's), like ``inserted_at`` which an
      ``ON CONFLICT DO UPDATE`` does not touch.
    - A primary key cannot be NULL: rows with a NULL in the key are dropped, or fail the query
      (``null_keys="error"``, a check inside the merge's own plan).
    - ``target=None`` reduces a batch on its own (an upsert into an empty table).
    - ``order_in_target=True``: the stored rows keep their source order columns,
      and versions compete by that order (batch wins ties). Replays and batches
      that arrive out of order then give the same table as in-order loading.
    """
    columns = list(columns or (target.columns if target is not None
                               else [c for c in batch.columns if c not in order]))
    values = [c for c in columns if c not in keys and c not in preserve]
    t_ord, b_ord = _orders(batch, order, order_in_target)
    b = batch.select(*columns, b_ord.alias(_ORD))
    if target is not None:
        b = target.select(*columns, t_ord.alias(_ORD)).unionByName(b)
    both = _with_keys(b, keys, null_keys)
    aggs = []
    if values:
        aggs.append(F.max_by(F.struct(*values), F.col(_ORD)).alias("__last"))
    if preserve:
        aggs.append(F.min_by(F.struct(*preserve), F.col(_ORD)).alias("__first"))
    merged = both.groupBy(*keys).agg(*aggs)
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
        elif c in preserve:
            out.append(F.col(f"__first.{c}").alias(c))
        else:
            out.append(F.col(f"__last.{c}").alias(c))
    return merged.select(*out)


def _orders(batch: DataFrame, order: list[str], order_in_target: bool) -> tuple[Column, Column]:
    """Order structs of a stored row and of a batch row."""
    own = [F.col(c) for c in order]
    if order_in_target:
        return F.struct(*own, F.lit(0).alias(_SRC)), F.struct(*own, F.lit(1).alias(_SRC))
    none = [F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in order]
    return F.struct(F.lit(0).alias(_SRC), *none), F.struct(F.lit(1).alias(_SRC), *own)


def _with_keys(rows: DataFrame, keys: list[str], null_keys: str) -> DataFrame:
    """Rows whose key is present; with ``null_keys="error"`` another row fails the query."""
    if null_keys != "error":
        return rows.filter(_keys_present(keys))
    return rows.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}")).cast(rows.schema[k].dataType)) for k in keys})


def merge_files(stored: DataFrame, batch: DataFrame, keys: list[str], order: list[str], preserve: tuple[str, ...],
                columns: list[str], order_in_target: bool = False, null_keys: str = "drop") -> DataFrame:
    """``merge_last_wins`` of two scans of Parquet files (filters on them are fine), winners first.

    The first phase reads keys, order and ``preserve`` columns, and folds a hot key's rows before the
    shuffle like any other's. The second joins on the row address, which is unique, so a hot key's rows
    spread over all tasks; the winners are the hashed side (an address and the ``preserve`` columns a
    row) and the payload streams past them. Versions with the same order compete by address.
    """
    t_ord, b_ord = _orders(batch, order, order_in_target)
    old, new = _addressed(stored, 0), _addressed(batch, 1)
    narrow = [*keys, *preserve, *_ADDRESS]
    rows = old.select(*narrow, t_ord.alias(_ORD)).unionByName(new.select(*narrow, b_ord.alias(_ORD)))
    seq = F.struct(_ORD, *_ADDRESS)
    kept = [F.min_by(F.struct(*preserve), seq).alias("__first")] if preserve else []
    winners = (_with_keys(rows, keys, null_keys).groupBy(*keys).agg(F.max_by(F.struct(*_ADDRESS), seq).alias("__last"), *kept)
               .select("__last.*", *(["__first.*"] if preserve else [])))
    wide = [*[c for c in columns if c not in preserve], *_ADDRESS]
    return old.select(*wide).unionByName(new.select(*wide)).join(winners.hint("shuffle_hash"), _ADDRESS).select(*columns)


def _addressed(rows: DataFrame, side: int) -> DataFrame:
    """Rows with their address: the last folder and the file name tell the files of a scan apart."""
    return rows.select("*", F.lit(side).alias("__from"), F.substring_index("_metadata.file_path", "/", -2).alias("__file"),
                       F.col("_metadata.row_index").alias("__row"))


def table_exists(spark: SparkSession, path: str) -> bool:
    try:
        fs, hpath = fs_path(spark, path)
    except Exception:  # noqa: BLE001 - remote session: probe by reading the footer
        try:
            spark.read.parquet(path).schema
            return True
        except Exception:  # noqa: BLE001
            return False
    return fs.exists(hpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own staging."""
    fs, hpath = fs_path(spark, path)
    fs.delete(hpath, True)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                     partition_by: list[str]) -> None:
    """K9: an empty table with the fixed schema on first use."""
    if not table_exists(spark, path):
        (spark.createDataFrame([], schema).write.mode("overwrite")
         .partitionBy(*partition_by).parquet(path))


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, schema: T.StructType,
                 keys: list[str], order: list[str], partition_by: list[str],
                 preserve: tuple[str, ...] = (), order_in_target: bool = False,
                 partition_follows_key: bool = True, null_keys: str = "error", staged: bool = False,
                 winners_first: bool = False) -> DataFrame:
    """Upsert ``batch`` into the Parquet table at ``path``; returns the batch's counts:
    rows upserted, distinct keys, and rows left out because their key is NULL.

    A NULL in a key fails the upsert (a NOT NULL constraint) before the table changes;
    ``null_keys="drop"`` leaves such rows out and counts them. ``staged``: the batch is a
    scan of Parquet files already (with filters at most), and is not written once more. ``winners_first`` merges by ``merge_files``. Only touched partitions are read and
    rewritten:

    - ``partition_follows_key=True``: the partition value is a function of the
      key (the weather cache's ``date_utc`` of ``hour_utc``), so the batch's own
      partition values are all that is touched.
    - ``partition_follows_key=False``: the partition value comes from the row
      (the incidents' occurrence month, which an update can change). The
      partitions the batch's keys live in now come from an index beside the table
      (``locator``), of which only the batch's buckets are read; a
      partition whose last rows moved out is removed.

    Rows are counted where they are written: by metrics observed on the batch's own write, or by
    one narrow aggregate of a staged batch.
    """
    ensure_utc(batch.sparkSession)
    if len(partition_by) != 1:
        raise ValueError("one partition column is supported")
    if null_keys not in ("error", "drop"):
        raise ValueError("null_keys is 'error' or 'drop'")
    finish_swaps(spark, path)
    create_if_absent(spark, path, schema, partition_by)
    work = f"{staging_root(path)}/{uuid.uuid4().hex}"
    try:
        counts = _merge_into(spark, path, work, batch, schema, keys, order, partition_by[0], preserve, order_in_target,
                             partition_follows_key, null_keys, staged, winners_first)
    except Exception:
        remove(spark, work)
        raise
    fs, ready = fs_path(spark, f"{work}/{READY}")
    fs.create(ready).close()
    finish_swaps(spark, path)
    return spark.createDataFrame([counts], "rows_upserted long, distinct_keys long, null_keys long")


def _merge_into(spark: SparkSession, path: str, work: str, batch: DataFrame, schema: T.StructType, keys: list[str], order: list[str], p: str,
                preserve: tuple[str, ...], order_in_target: bool, partition_follows_key: bool, null_keys: str, staged: bool,
                winners_first: bool) -> tuple[int, int, int]:
    """Write the merge of the batch under ``work``; the batch's counts."""
    columns = [f.name for f in schema.fields]
    rows, nulls = F.count_if(_keys_present(keys)).alias("rows"), F.count_if(~_keys_present(keys)).alias("nulls")
    if staged:
        seen = batch.agg(rows, nulls).first().asDict()
    else:
        written = Observation()
        batch.observe(written, rows, nulls).write.parquet(f"{work}/batch")       # parsed once, whatever reads it below
        seen = written.get
        batch = spark.read.schema(batch.schema).parquet(f"{work}/batch")
    stored = spark.read.schema(schema).parquet(path)
    touched = batch.select(p)
    if not partition_follows_key:
        asked = batch.where(_keys_present(keys)).select(*keys).distinct()
        index = KeyIndex(spark, path, stored, keys, p)
        index.known(asked).write.parquet(f"{work}/known")
        known = spark.read.schema(T.StructType([schema[c] for c in (*keys, p)])).parquet(f"{work}/known")
        touched = touched.unionByName(known.select(p))
    touched.distinct().write.parquet(f"{work}/touched")
    touched = spark.read.schema(touched.schema).parquet(f"{work}/touched")
    merge = merge_files if winners_first else merge_last_wins
    merged = merge(_in_partitions(stored, touched, p), batch, keys, order, preserve, columns, order_in_target, null_keys)
    # One task or a few for each partition (hot ones are split, small ones share), files sorted by key.
    (merged.hint("rebalance", p).sortWithinPartitions(p, *keys)
     .write.partitionBy(p).parquet(f"{work}/merged"))
    if not partition_follows_key:
        written = spark.read.schema(schema).parquet(f"{work}/merged")
        new = written.select(*keys, p).join(asked, keys, "left_semi").exceptAll(known)      # nulls compare equal
        index.add(new, work.rsplit("/", 1)[1])
        written = written.select(p).distinct()
        (touched.join(written.withColumnRenamed(p, "__p"), F.col(p).eqNullSafe(F.col("__p")), "left_anti")
         .select(F.coalesce(F.col(p).cast("string"), F.lit(NO_VALUE)).alias("value")).write.parquet(f"{work}/emptied"))
    distinct = batch.where(_keys_present(keys)).select(*keys).distinct().count()
    return seen.get("rows") or 0, distinct, seen.get("nulls") or 0


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"     # fixed value: the folder name of a NULL partition


def staging_root(path: str) -> str:
    return f"{path.rstrip('/')}.staging"


def _keys_present(keys: list[str]):
    return reduce(lambda a, c: a & c, [F.col(k).isNotNull() for k in keys])


def _in_partitions(stored: DataFrame, touched: DataFrame, p: str) -> DataFrame:
    """Stored rows of the touched partitions. Their names (as many as folders will be moved) are literals
    of the partition filter, so the folders of the others are not opened, whatever the optimiser makes of a join."""
    values = [r[0] for r in touched.distinct().collect()]
    named = F.col(p).isin([v for v in values if v is not None])
    return stored.where(named | F.col(p).isNull() if None in values else named)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Move finished merges into place (again, if a driver died doing so) and drop the staging folders.

    Each step can be repeated: a partition folder is replaced as long as its new one is still
    in staging. Only folder names are handled here, never rows.
    """
    fs, root = fs_path(spark, staging_root(path))
    if not fs.exists(root):
        return
    for folder in [f.getPath().toString() for f in fs.listStatus(root)]:
        if fs.exists(fs_path(spark, f"{folder}/{READY}")[1]):
            if fs.exists(fs_path(spark, f"{folder}/emptied")[1]):
                for row in spark.read.schema("value string").parquet(f"{folder}/emptied").toLocalIterator():
                    _delete_partition(spark, path, _partition_column(fs, spark, path, folder), row["value"])
            merged = fs_path(spark, f"{folder}/merged")[1]
            for part in [f.getPath() for f in fs.listStatus(merged) if f.isDirectory()]:
                target = fs_path(spark, f"{path.rstrip('/')}/{part.getName()}")[1]
                if fs.exists(target):
                    fs.delete(target, True)
                if not fs.rename(part, target):
                    raise OSError(f"cannot move {part.toString()} to {target.toString()}")
        fs.delete(fs_path(spark, folder)[1], True)
    fs.delete(root, True)
    spark.catalog.refreshByPath(path)


def _partition_column(fs, spark: SparkSession, path: str, folder: str) -> str:
    """Name of the partition column, from the folders of the table or of the merge."""
    for place in (path, f"{folder}/merged"):
        for f in fs.listStatus(fs_path(spark, place)[1]):
            if f.isDirectory() and "=" in f.getPath().getName():
                return f.getPath().getName().split("=", 1)[0]
    raise ValueError(f"no partition folders under {path}")


def _delete_partition(spark: SparkSession, path: str, column: str, value: str) -> None:
    """Remove one partition folder (all its rows moved to other partitions)."""
    fs, hpath = fs_path(spark, f"{path.rstrip('/')}/{column}={value}")
    if fs.exists(hpath):
        fs.delete(hpath, True)
