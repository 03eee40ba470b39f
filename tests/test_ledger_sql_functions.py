"""Batch ledgers, bounded runs, and functions of SQL text."""

from __future__ import annotations

import time
import uuid

import pytest
from pyspark.sql import functions as F

from tablekit.operators import sql_functions
from tablekit.plans import queries
from tablekit.streaming import ledger

from conftest import SF_SMALL


def rows(spark, starts, seconds):
    return spark.createDataFrame([(i, s, 1, d) for i, (s, d) in enumerate(zip(starts, seconds))],
                                 "batch_id long, at double, rows long, seconds double").withColumn(
        "started", F.timestamp_micros((F.col("at") * 1e6).cast("long"))).drop("at")


@pytest.mark.parametrize("starts,seconds,kept", [
    ([101.3, 102.0, 104.0], [0.5, 0.4, 0.4], [True, True, True]),  # multiples of 2
    ([101.3, 105.1, 106.0], [3.7, 0.2, 0.2], [True, True, True]),  # a long batch: at its end
    ([101.3, 101.9, 102.4], [0.5, 0.4, 0.1], [True, False, True]),  # no interval
    ([100.0, 110.0, 120.0], [0.5, 0.4, 0.4], [True, False, False])])  # ten seconds
def test_interval_report(spark, starts, seconds, kept):
    got = ledger.interval_report(rows(spark, starts, seconds), 2).orderBy("batch_id").collect()
    assert [r["on_time"] for r in got] == kept


def stream(spark, tmp_dir, interval):
    feed = f"{tmp_dir}/feed"
    spark.range(40).select(F.col("id").cast("string").alias("value"), (F.col("id") % 4).alias("feed")) \
        .repartition(1).write.partitionBy("feed").text(feed)
    lines = spark.readStream.format("text").schema("value string, feed int").option("maxFilesPerTrigger", 1).load(feed)
    name = f"tk_{uuid.uuid4().hex}"
    book = ledger.BatchLedger(name)
    spark.streams.addListener(book)
    q = ledger.per_batch_rows(lines, lambda b: b.groupBy("feed").agg(F.count("*").alias("n")), f"{tmp_dir}/sink",
                              f"{tmp_dir}/ckpt", name, interval)
    return q, book


def test_another_interval_fails_the_report(spark, tmp_dir):
    """The same feed without an interval: the report of two seconds says so."""
    q, book = stream(spark, tmp_dir, "0 seconds")
    ran = ledger.run_bounded(q, 60, lambda: len(book.rows) >= 4)
    spark.streams.removeListener(book)
    assert ran < 60 and not q.isActive
    report = ledger.interval_report(book.table(spark), 2).collect()
    assert len(report) == 4 and not all(r["on_time"] for r in report)
    assert sum(r["rows"] for r in report) == 40
    book.flush(spark, f"{tmp_dir}/ledger")
    assert not book.rows and spark.read.parquet(f"{tmp_dir}/ledger").count() == 4
    assert spark.read.parquet(f"{tmp_dir}/sink").agg(F.sum("n")).first()[0] == 40


def test_a_run_ends_at_its_bound(spark, tmp_dir):
    q, book = stream(spark, tmp_dir, "10 seconds")
    began = time.monotonic()
    ran = ledger.run_bounded(q, 2)
    spark.streams.removeListener(book)
    assert 2 <= ran <= time.monotonic() - began < 15 and not q.isActive


def test_sql_functions_leave_no_call_in_the_plan(spark):
    for name in ("sql_udf_scalar", "sql_udf_predicate"):
        plan = queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "udf" not in plan.lower()
        assert name == "sql_udf_scalar" or "PushedFilters: [Or(StringStartsWith" in plan
    with pytest.raises(ValueError):
        sql_functions.sql_function(spark, "a b", "x int", "int", "x")


def test_sql_function_is_replaced(spark):
    name = sql_functions.sql_function(spark, f"f_{uuid.uuid4().hex}", "x int", "int", "x + 1")
    assert spark.sql(f"SELECT {name}(1)").first()[0] == 2
    sql_functions.sql_function(spark, name, "x int", "int", "x + 2")
    assert spark.sql(f"SELECT {name}(1), {name}(NULL)").first()[:] == (3, None)


def test_table_function_rows(spark):
    class Halves:
        def eval(self, n: int):
            for k in range((n or 0) // 2):
                yield (k,)
    name = sql_functions.table_function(spark, f"g_{uuid.uuid4().hex}", Halves, "k int")
    got = spark.sql(f"SELECT n, k FROM VALUES (0), (1), (5), (NULL) AS t(n), LATERAL {name}(n)").collect()
    assert sorted(map(tuple, got)) == [(5, 0), (5, 1)]
