"""Every catalogued query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from geoloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


@pytest.fixture(scope="module")
def con(small):
    c = duckdb.connect()
    for t in TABLES:
        p = f"{small}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if os.path.isdir(p) else ''}')")
    return c


def cell(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "-"
    return f"{float(x):.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_agrees_with_sql(spark, con, small, name):
    df = catalog.QUERIES[name](spark, small)
    found = con.execute(catalog.SQL[name])
    names = [d[0] for d in found.description]
    order = sorted(names)
    assert sorted(df.columns) == order
    want = sorted(tuple(cell(r[names.index(c)]) for c in order) for r in found.fetchall())
    got = sorted(tuple(cell(r[c]) for c in order) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_runs(spark, small, name):
    catalog.QUERIES[name](spark, small).collect()
