"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402
from regmill.plans.catalog import registry  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    frame = QUERIES[name](spark, SF)
    got = frame.toPandas()
    want = con.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want.to_arrow_table().to_pandas())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
