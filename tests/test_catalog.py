"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from feedloom.catalog import ORACLE, QUERIES
from tools.check_queries import canonical

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Their small forests need more rows than the smallest tables hold.
NEEDS_ROWS = {"profile_prediction": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    rel = sql.execute(ORACLE[name])
    want = canonical([d[0] for d in rel.description], rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, NEEDS_ROWS.get(name, SF)).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_registers_the_catalog():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 65
    assert df.count() > 0
