"""The number of splits of the numbered files does not grow with their bytes."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tablekit.plans import source_queries

NAMES = ("file_positions", "file_first_lines", "file_drop_header")


@pytest.mark.parametrize("most, own", [(6, None), (6, "3000b")])
def test_splits_grow_with_the_files(spark, tmp_dir, monkeypatch, most, own):
    rows = [(i, "\n".join(f"line {i} {k}" for k in range(i % 9 + 1))) for i in range(1500)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    monkeypatch.setattr(source_queries, "SPLIT_BYTES", 1000)
    monkeypatch.setattr(source_queries, "MOST_SPLITS", most)
    path = source_queries._folders_of_lines(spark, tmp_dir)
    session = spark.newSession()
    if own:  # splits are no larger than the session's own
        session.conf.set("spark.sql.files.maxPartitionBytes", own)
    splits = source_queries._small_splits(session, path).read.text(path).rdd.getNumPartitions()
    size = sum(r[0] for r in spark.read.format("binaryFile").load(path).select("length").collect())
    assert size > 60_000
    assert size // 3000 <= splits <= 2 * size // 3000 if own else splits <= 2 * most
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    for name in NAMES:
        got = sorted(map(tuple, entry.queries()[name](session, tmp_dir).collect()))
        assert got == sorted(con.execute(entry.oracle_sql()[name]).fetchall()), name
