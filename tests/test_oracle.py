"""Every registered query with an oracle statement equals DuckDB on the small tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from gazette.sources.tables import TABLES

ORACLE = E.oracle_sql()
SLOW = {"pipeline"}            # tested stage by stage in its own folder


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf, con, name):
    df = E.queries()[name](spark, sf)
    cols = df.columns
    got = Counter(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
    rel = con.sql(ORACLE[name])
    dcols = rel.columns
    assert sorted(cols) == sorted(dcols)
    idx = [dcols.index(c) for c in sorted(dcols)]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_every_query_runs(spark, sf):
    for name, fn in E.queries().items():
        if name in ORACLE or name in SLOW:
            continue
        df = fn(spark, sf)
        assert df.count() > 0, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "slug" in df.columns
