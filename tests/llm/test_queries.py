"""Registered queries against their SQL on the smallest tables, and the entry's guard."""

import glob
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from feedloom.llm.queries import ORACLE, QUERIES
from tools.check_queries import canonical

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.abspath(entry.__file__))


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
    assert got == canonical([d[0] for d in rel.description], rel.fetchall())


def test_entry_lists_the_operators_and_the_pipeline():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names


def test_the_rest_imports_without_the_subpackage(tmp_path):
    for d in ("feedloom", "tools"):
        os.makedirs(tmp_path / d)
        for f in os.listdir(f"{ROOT}/{d}"):
            if f != "llm":
                os.symlink(f"{ROOT}/{d}/{f}", tmp_path / d / f)
    os.symlink(f"{ROOT}/__spark_entry__.py", tmp_path / "own_entry.py")
    code = ("import sys; sys.path.insert(0, '.'); import feedloom.catalog as c; "
            "src = open('own_entry.py').read().replace('__file__', repr('./own_entry.py')); "
            "ns = {}; exec(compile(src, 'e', 'exec'), ns); "
            "assert set(ns['queries']()) == set(c.QUERIES); assert 'feedloom.llm' not in sys.modules")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env=env, check=True)


def test_nothing_else_imports_the_subpackage():
    for top, dirs, names in os.walk(f"{ROOT}/feedloom"):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        for n in names:
            if n.endswith(".py"):
                assert "feedloom.llm" not in open(os.path.join(top, n)).read(), n
