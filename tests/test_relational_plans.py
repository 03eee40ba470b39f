from __future__ import annotations

import importlib

from pyspark.sql import functions as F

from tablekit.operators import relational
from tablekit.plans import queries
from tablekit.plans.explain import plan_text

from conftest import SF_SMALL

q = importlib.import_module("tablekit.plans.queries")


def test_word_count_plan_partial_and_final_aggregate(spark):
    df = spark.createDataFrame([("a b a",), ("b c",)], "value string")
    plan = plan_text(relational.word_count(df))
    tree = plan.split("\n\n")[0]
    assert tree.count("HashAggregate") == 2
    assert "hashpartitioning(word" in plan
    assert "EvalPython" not in plan


def test_count_by_key_pre_aggregates_before_dimension_joins(spark):
    df = queries()["count_by_key"](spark, SF_SMALL)
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan
    # the fact side is reduced per nation key (its own aggregate and shuffle)
    # before it meets the dimensions, then once more per region
    assert "hashpartitioning(c_nationkey" in plan and "hashpartitioning(r_name" in plan
    assert plan.split("\n\n")[0].count("HashAggregate") == 4
    assert sum(r.n for r in df.collect()) == spark.read.parquet(
        f"{SF_SMALL}/customer.parquet").count()


def test_filter_and_projection_reach_the_scan(spark):
    plan = plan_text(queries()["filter_gt"](spark, SF_SMALL))
    assert "GreaterThan(p_retailprice,950.0)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_retailprice:double>" in plan
    plan = plan_text(queries()["project_cols"](spark, SF_SMALL))
    assert "ReadSchema: struct<p_name:string>" in plan


def test_comma_join_is_an_equi_join(spark):
    plan = plan_text(queries()["inner_join_comma"](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "HashJoin" in plan or "SortMergeJoin" in plan


def test_distinct_set_line(spark):
    df = spark.createDataFrame([("Asia",), ("Europe",), ("Asia",), (None,), ("Africa",)],
                               "c string")
    assert relational.distinct_set_line(df, "c").first()[0] == "Africa,Asia,Europe"
    assert [r.c for r in relational.distinct_values(df, "c").collect()] == ["Africa", "Asia", "Europe"]
    empty = relational.distinct_set_line(df.limit(0), "c")
    assert empty.first()[0] == ""


def test_plans_are_built_without_jobs(spark):
    """No query input is counted or run while its plan is made."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "plans")
    try:
        labelled = q._labelled_docs(spark, SF_SMALL)
        relational.distinct_set_line(q.T(spark, SF_SMALL, "customer"), "c_mktsegment")
        q.textf.normalize_lines(q.doc_lines(spark, SF_SMALL))
        labelled.select("label")
        jobs = tracker.getJobIdsForGroup("plan-only")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    schema_reads = 6  # a Parquet read may list or infer; no shuffle stage is run
    assert all(len(tracker.getJobInfo(j).stageIds) <= 1 for j in jobs) and len(jobs) <= schema_reads


def test_order_report_sees_inversions(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(70)], "k int, v int")
    good = relational.order_report(df.orderBy("k"), "k").first()
    assert (good.n, good.inversions_within, good.inversions_between) == (70, 0, 0)
    bad = relational.order_report(df.coalesce(1), "k").first()
    assert bad.inversions_within == 9


def test_hash_split_is_stable_across_partitionings(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a = relational.split_label(df, ["k"], [0.7, 0.3])
    b = relational.split_label(df.repartition(7), ["k"], [0.7, 0.3])
    assert a.exceptAll(b).count() == 0
    share = a.where(F.col("part") == 0).count() / 2000
    assert 0.65 < share < 0.75
    parts = relational.hash_split(df, ["k"], [0.5, 0.25, 0.25])
    assert sum(p.count() for p in parts) == 2000


def test_random_split_disjoint_and_covering(spark):
    rows = queries()["random_split"](spark, SF_SMALL).collect()
    assert all(r.parts == 1 and r.near_weights for r in rows)
    assert len(rows) == q.T(spark, SF_SMALL, "orders").count()


def test_top_n_and_sort(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "k int, v double")
    got = [r.k for r in relational.top_n(df, 3, F.col("v").desc(), F.col("k")).collect()]
    assert got == [6, 13, 20]


def test_sum_by_key_and_filtered_sum(spark):
    df = spark.createDataFrame([("TUR", 10), ("TUR", 5), ("USA", 7)], "cc string, pop long")
    assert relational.filtered_sum(df, F.col("cc") == "TUR", "pop").first().total == 15
    got = {r.cc: r.total for r in relational.sum_by_key(df, "cc", "pop").collect()}
    assert got == {"TUR": 15, "USA": 7}


def test_global_count(spark):
    assert relational.global_count(spark.range(123)).first().n == 123


def test_bucketed_tables_join_without_shuffle(spark, tmp_dir):
    from tablekit import sinks
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    cust = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    sinks.write_bucketed(orders.select("o_orderkey", "o_custkey"), "tk_b_orders", "o_custkey",
                         8, path=tmp_dir + "/o")
    sinks.write_bucketed(cust.select("c_custkey", "c_name"), "tk_b_cust", "c_custkey", 8,
                         path=tmp_dir + "/c")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("tk_b_orders").join(spark.table("tk_b_cust"),
                                            F.col("o_custkey") == F.col("c_custkey"))
        plan = plan_text(j)
        assert "SortMergeJoin" in plan and "Exchange" not in plan.split("\n\n")[0]
        assert j.count() == orders.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_hot_key_join_is_split_by_aqe(spark):
    """One key holds a third of the fact rows: AQE splits its partition."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        j = relational.join(fact, dim, "k")
        assert j.count() == 60000
        j.collect()
        final = plan_text(j)
        assert "skew=true" in final
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
