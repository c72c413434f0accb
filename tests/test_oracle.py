"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, rows_of

SF = os.environ.get("SQUALL_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    missing = set(entry.QUERY_NAMES) - set(entry.oracle_sql())
    assert not missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "event_id" in df.columns


@pytest.mark.parametrize("name", entry.QUERY_NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    drows = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(cols)
    assert rows_of(srows, sdf.columns) == rows_of(drows, cols)
