"""Queries with DuckDB SQL: equal rows on whole tables."""

import duckdb
import pytest

from tablestream.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    out = QUERIES[name](spark, SF)
    want = con.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(out.columns)
    assert sorted(map(str, want.select(", ".join(out.columns)).fetchall())) == sorted(str(tuple(r)) for r in out.collect())
