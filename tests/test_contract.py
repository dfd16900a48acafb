"""Driver contract: entry() runs; every query has SQL and matches it at sf0.001."""

import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sousflow.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def digest(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    c = Counter(repr(tuple(norm(r[i]) for i in order)) for r in data)
    return hashlib.sha256("".join(f"{k}:{c[k]}\n" for k in sorted(c)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["session_date", "num_sessions", "avg_session_length_seconds",
                          "avg_num_searches_before_viewing_recipe", "most_viewed_recipe"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(got) == len(want)
    assert digest(df.columns, got) == digest(rel.columns, want)
