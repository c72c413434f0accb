"""Data-quality checks (D1-D6) as one-row aggregates, unioned into a report.

Each check is a single distributed aggregate over the checked table: a count
of failing rows. ``unique`` groups by the key (map-side partial counts, then
one shuffle by key) and counts keys seen more than once. Nothing is collected
per row; a report is one row per (model, check).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, model: str, check: str, column: str, failures) -> DataFrame:
    return df.agg(failures.cast("bigint").alias("failures")).select(
        F.lit(model).alias("model"), F.lit(check).alias("check"), F.lit(column).alias("column"),
        "failures", (F.col("failures") == 0).alias("passed"))


def not_null(df: DataFrame, model: str, column: str) -> DataFrame:
    """``not_null``: rows whose column is NULL."""
    return _row(df, model, "not_null", column, F.count_if(F.col(column).isNull()))


def unique(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """``unique``: keys that occur more than once."""
    dup = df.groupBy(*columns).count().filter(F.col("count") > 1)
    return _row(dup, model, "unique", ",".join(columns), F.count(F.lit(1)))


def key_checks(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """``not_null`` of each key column and ``unique`` of the key from one grouped aggregate.

    Rows are counted per key (map-side partial counts, one shuffle); keys with a NULL
    form their own groups, so all checks read the same small per-key table.
    """
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    per_key = df.groupBy(*columns).count()
    nulls = [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("count"))), F.lit(0)).cast("bigint").alias(f"n{i}")
             for i, c in enumerate(columns)]
    totals = per_key.agg(*nulls, F.count_if(whole & (F.col("count") > 1)).cast("bigint").alias("d"))

    def row(check: str, column: str, failures: str):
        return F.struct(F.lit(check).alias("check"), F.lit(column).alias("column"), F.col(failures).alias("failures"))

    rows = F.array(*[row("not_null", c, f"n{i}") for i, c in enumerate(columns)], row("unique", ",".join(columns), "d"))
    return totals.select(F.inline(rows)).select(
        F.lit(model).alias("model"), "check", "column", "failures", (F.col("failures") == 0).alias("passed"))


def accepted_values(df: DataFrame, model: str, column: str, values) -> DataFrame:
    """``CHECK col IN (...)``: rows with any other value, NULL included."""
    bad = ~F.coalesce(F.col(column).isin(*values), F.lit(False))
    return _row(df, model, "accepted_values", column, F.count_if(bad))


def non_empty(df: DataFrame, model: str) -> DataFrame:
    """At least one row (D5); an existence probe, so it reads one row at most."""
    probe = df.limit(1)
    return _row(probe, model, "non_empty", "*", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


def has_column(df: DataFrame, model: str, column: str) -> DataFrame:
    """Required column present (D5); decided from the schema, no scan."""
    ok = column in df.columns
    spark = df.sparkSession
    return spark.range(1).select(
        F.lit(model).alias("model"), F.lit("has_column").alias("check"),
        F.lit(column).alias("column"), F.lit(0 if ok else 1).cast("bigint").alias("failures"),
        F.lit(ok).alias("passed"))


def report(checks: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)
