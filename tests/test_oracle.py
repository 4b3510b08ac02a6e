"""Every registered query against its DuckDB oracle (sf0.001), plus the entry contract."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from orderlake.plans import registry
from orderlake.sources.tables import TABLES
from tests.conftest import SF0001

HEAVY = {"order_pca", "pca_explained_variance", "dbscan_orders", "cluster_distribution",
         "clustering_results", "cluster_scatter_bins", "hdbscan_orders", "hdbscan_scatter_bins"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    return v


def _close(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return (math.isnan(a) and math.isnan(b)) or abs(a - b) <= 1e-9 * max(abs(a), abs(b), 1e-300)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return float(a) == float(b)
    return a == b


def _key(r):
    return tuple((x is None, "" if x is None else type(x).__name__, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    srows = sorted((tuple(_norm(r[c]) for c in order) for r in df.collect()), key=_key)
    idx = [dcols.index(c) for c in order]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=_key)
    assert len(srows) == len(drows)
    for a, b in zip(srows, drows):
        assert all(_close(x, y) for x, y in zip(a, b)), (a, b)


def test_every_query_runs_and_entry_has_rows(spark):
    assert E.entry(spark).count() > 0
    for name, fn in registry.queries().items():
        if name in E.oracle_sql() or name in HEAVY:
            continue
        assert fn(spark, SF0001).count() > 0, name
