"""Every core query with SQL equals DuckDB on the smallest tables, and every core query runs."""

import glob
import math
import os

import duckdb
import pytest

from fundloom.plans import registry

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{ROOT}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return f"{v:.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, ROOT)
    got = df.collect()
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return
    r = duck.execute(sql)
    cols = [d[0] for d in r.description]
    want = r.fetchall()
    order = sorted(df.columns)
    assert order == sorted(cols)
    assert sorted(str([norm(x[c]) for c in order]) for x in got) == sorted(str([norm(x[cols.index(c)]) for c in order]) for x in want)
