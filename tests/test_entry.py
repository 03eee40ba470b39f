"""Driver contract: entry(), queries() and oracle_sql() agree at sf0.001."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tablekit.sources.tables import TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_oracles_are_a_subset_of_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _canon(df.columns, df.collect()) == _canon(ocols, res.fetchall())
