import importlib.util
import math
import os

import duckdb
import pytest

from tessera.plans.registry import load_all
from tessera.sources.tables import TABLES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_contract(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.columns == ["vertex", "rank"] and df.count() > 0
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float):
            return round(x, 9) + 0.0 if not math.isnan(x) else "nan"
        return x.item() if hasattr(x, "item") else x
    return sorted(repr(tuple(v(r[i]) for i in order)) for r in rows)


SQL_QUERIES = sorted(n for n, q in load_all().items() if q.sql)


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_query_matches_duckdb(spark, duck, name):
    q = load_all()[name]
    sdf = q.build(spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(q.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _norm(srows, sdf.columns) == _norm(drows, dcols)
