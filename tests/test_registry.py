"""Every registered query against its SQL, and the entry points."""

import decimal
import glob
import os

import pytest

import __spark_entry__
from terrella.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split()


@pytest.fixture(scope="module")
def duck(sf):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(v):
    v = float(v) if isinstance(v, decimal.Decimal) else v
    return float(f"{v:.12g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    df = registry.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(registry.ORACLES[name])
    at = [d[0] for d in found.description]
    assert sorted(at) == columns
    assert got == sorted((tuple(plain(r[at.index(c)]) for c in columns) for r in found.fetchall()), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 5
    assert set(registry.QUERIES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_no_scan_of_unneeded_columns(spark, sf):
    plan = registry.QUERIES["g1_filtered_count"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan and "GreaterThan(l_quantity,30.0)" in plan


def test_nothing_else_imports_llm():
    root = os.path.dirname(os.path.dirname(os.path.abspath(registry.__file__)))
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        if "/llm/" not in path:
            assert "terrella.llm" not in open(path).read(), path
