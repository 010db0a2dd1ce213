
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from shoplens.plans.registry import ORACLE, QUERIES
from shoplens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["area", "product_id", "product_name", "clickcount", "cityremark"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == want


def test_entry_works_without_the_corpus_part():
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("shoplens.llm"):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as E
from shoplens.plans.registry import ORACLE, QUERIES
assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
