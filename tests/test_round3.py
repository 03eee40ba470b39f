"""Whole jobs and bounded tasks: dealt lines, folders of part files, training partitions."""

from __future__ import annotations

import os
import pickle

import duckdb
import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tablekit.functions.vectors import assemble
from tablekit.llm import words
from tablekit.llm.base import Texts
from tablekit.operators import models
from tablekit.plans import source_queries
from tablekit.sources import positions, tables


def documents(spark, folder, rows) -> str:
    """A tables folder that has only ``documents``."""
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(os.path.join(folder, "documents.parquet"))
    return folder


def by_sql(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    return con.execute(entry.oracle_sql()[name]).fetchall()


def test_min_partition_scan_deals_lines_over_all_partitions(spark, tmp_dir):
    sf = documents(spark, tmp_dir, [(i, "\n".join(f"line {i} {k}" for k in range(i % 5 + 1))) for i in range(300)])
    got = entry.queries()["min_partition_scan"](spark, sf)
    assert got.columns == ["n", "partitions"]
    assert [tuple(r) for r in got.collect()] == [(900, 16)] == by_sql(sf, "min_partition_scan")
    assert "RoundRobinPartitioning(16)" in got._jdf.queryExecution().executedPlan().toString()


def test_a_folder_is_written_in_parts_and_numbered_through(spark, tmp_dir, monkeypatch):
    sf = documents(spark, tmp_dir, [(i, "\n".join(f"line {i} {k}" for k in range(i % 7 + 1))) for i in range(2000, 0, -1)])
    monkeypatch.setattr(source_queries, "PART_BYTES", 5000)
    path = source_queries._folders_of_lines(spark, sf)
    sizes = [r["length"] for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 4 * source_queries.FOLDERS and max(sizes) < 4 * 5000
    for name in ("file_positions", "file_first_lines", "file_drop_header"):
        got = entry.queries()[name](spark, sf)  # columns in the order of the SQL
        assert sorted(map(tuple, got.collect())) == sorted(by_sql(sf, name)), name


def test_line_numbers_go_on_over_the_parts_of_a_folder(spark, tmp_dir):
    for folder, part, lines in (("a", "1", 3), ("a", "2", 2), ("a-b", "1", 1), ("b", "1", 2)):
        os.makedirs(f"{tmp_dir}/{folder}", exist_ok=True)
        with open(f"{tmp_dir}/{folder}/part-{part}.txt", "w") as f:
            f.writelines(f"{folder} {part} {k}\n" for k in range(lines))
    for parts, want in ((True, [1, 1, 2, 3, 4, 5, 1, 2]), (False, [1, 1, 2, 3, 1, 2, 1, 2])):
        rows = positions.positioned_lines(spark, [f"{tmp_dir}/{d}" for d in ("a", "a-b", "b")], parts).orderBy("position").collect()
        assert [r["line_no"] for r in rows] == want and [r["position"] for r in rows] == list(range(1, 9))
        assert [r["value"][:3] for r in rows] == ["a-b", "a 1", "a 1", "a 1", "a 2", "a 2", "b 1", "b 1"]


class Fitted:
    """An estimator that tells the rows of each partition it is fitted on."""

    def fit(self, train):
        assert train.storageLevel.useMemory
        return sorted(r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect())


def test_trees_are_fitted_on_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "TREE_ROWS", 100)
    for parts, want in ((1, 50), (40, 40)):  # one large partition is dealt anew, small ones are kept
        sizes = models._fit_trees(Fitted(), spark.range(5000).repartition(parts))
        assert len(sizes) == want and sum(sizes) == 5000 and max(sizes) <= 2 * 100
    rows = spark.range(3000).repartition(1).selectExpr("id % 3 AS x", "cast(id % 3 = 1 AS double) AS label")
    forest = models.random_forest(assemble(rows, ["x"]), num_trees=3, max_depth=2)
    assert forest.transform(assemble(rows, ["x"])).where("prediction <> label").count() == 0


def test_spread_rows_grows_with_the_rows(spark, tmp_dir):
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_dir}/t")
    scan, least = spark.read.parquet(f"{tmp_dir}/t"), spark.sparkContext.defaultParallelism
    for rows, want in ((50, 100), (1 << 18, least)):
        got = tables.spread_rows(scan, ["id"], rows)
        assert got.rdd.getNumPartitions() == max(want, least) and got.distinct().count() == 5000


def test_functions_are_sent_without_what_the_driver_computed():
    text = np.frombuffer(b"some words", np.uint8)
    one = words.words(Texts(text, np.array([0, len(text)]), slice(0, 1)), words.BY_LETTER)
    sent = cloudpickle.dumps(words.words)
    assert words._POWERS and len(sent) < 100_000
    there = pickle.loads(sent)(Texts(text, np.array([0, len(text)]), slice(0, 1)), words.BY_LETTER)
    assert there[0].tolist() == one[0].tolist() and there[1].tolist() == one[1].tolist()
