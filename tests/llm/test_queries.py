"""Registered queries against their DuckDB SQL, and what is registered."""

import duckdb
import pytest

import __spark_entry__ as entry
from squall.llm import queries as Q

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator_and_the_pipeline():
    names = list(Q.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries()) and set(Q.SQL) <= set(names)


@pytest.mark.parametrize("name", list(Q.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = Q.QUERIES[name](spark, SF)
    rel = con.execute(Q.SQL[name])
    cols = [c[0] for c in rel.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, got.select(*cols).collect())) == sorted(str(spark_row(cols, r)) for r in rel.fetchall())


def spark_row(cols, values):
    from pyspark.sql import Row

    return Row(*cols)(*values)
