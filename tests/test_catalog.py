"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import TABLES, digest  # noqa: E402
from tablestream.catalog.oracles import ORACLES  # noqa: E402
from tablestream.catalog.queries import QUERIES  # noqa: E402

SF = os.environ.get("TS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))   # other operators have their own tests
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = digest([tuple(r) for r in df.collect()], df.columns)
    res = con.sql(E.oracle_sql()[name])
    want = digest(res.fetchall(), res.columns)
    assert sorted(df.columns) == sorted(res.columns)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:2] == ["_sdc_source_key_o_orderkey", "_sdc_level_0_id"]
    assert df.count() > 0
