"""Replacement by switching: the old content stays until the new is whole."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from tablekit import sinks
from tablekit.sinks import staged


def half_way(spark, n=1000):
    """A frame whose last task fails after others have written their files."""
    return spark.range(0, n, 1, 4).select(
        F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("bigint").alias("id"))


def test_a_failing_writer_leaves_the_old_rows(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    with pytest.raises(FileNotFoundError):
        staged.current_folder(spark, path)
    first = staged.replace_folder(spark.range(10), path)
    with pytest.raises(Exception, match="broken"):
        staged.replace_folder(half_way(spark), path)
    assert staged.current_folder(spark, path) == first
    assert staged.read_folder(spark, path).count() == 10
    old = staged.read_folder(spark, path)
    second = staged.replace_folder(spark.range(3), path)
    assert first != second == staged.current_folder(spark, path)
    assert staged.read_folder(spark, path).count() == 3
    assert old.count() == 10  # a reader that began before
    # An empty frame replaces, too, and keeps its schema.
    staged.replace_folder(spark.range(0), path)
    assert staged.read_folder(spark, path).columns == ["id"] and staged.read_folder(spark, path).count() == 0


def test_overwriting_in_place_loses_the_old_rows(spark, tmp_dir):
    """What the staged form is for: a plain overwrite removes the old files first."""
    path = f"{tmp_dir}/plain"
    sinks.load_overwrite(spark.range(10), path)
    with pytest.raises(Exception, match="broken"):
        sinks.load_overwrite(half_way(spark), path)
    assert not [f for f in os.listdir(path) if f.startswith("part-")]


def test_a_frame_can_replace_what_it_reads(spark, tmp_dir):
    path = f"{tmp_dir}/self"
    staged.replace_folder(spark.range(10), path)
    staged.replace_folder(staged.read_folder(spark, path).where("id < 4"), path)
    assert staged.read_folder(spark, path).count() == 4


def test_catalog_table(spark, tmp_dir):
    name = f"tk_staged_{uuid.uuid4().hex}"
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, `odd name` string")
    staged.replace_table(rows, name, tmp_dir)
    assert spark.table(name).dtypes == rows.dtypes
    with pytest.raises(Exception, match="broken"):
        staged.replace_table(half_way(spark).withColumn("odd name", F.lit("x")), name, tmp_dir)
    assert spark.table(name).count() == 2
    # Columns by name, cast to the declared types; others are left out.
    staged.replace_table(spark.sql("SELECT 'z' AS `odd name`, 7L AS id, 1 AS more"), name, tmp_dir)
    assert [tuple(r) for r in spark.table(name).collect()] == [(7, "z")]
    spark.sql(f"DROP TABLE {name}")


def test_key_value_text(spark, tmp_dir):
    path = f"{tmp_dir}/kv"
    staged.replace_key_value_text(spark.createDataFrame([("b", 2), ('a"\t', 1)], "k string, n long"), path, "k", "n")
    with pytest.raises(Exception, match="broken"):
        staged.replace_key_value_text(half_way(spark).withColumn("n", F.lit(1)), path, "id", "n")
    got = sinks.read_key_value_text(spark, staged.current_folder(spark, path), "k", "n")
    assert {tuple(r) for r in got.collect()} == {("b", 2), ('a"\t', 1)}
