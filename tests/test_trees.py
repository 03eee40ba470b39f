"""Node rows, rule expressions and votes against the models' own transform."""

from __future__ import annotations

import pytest
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tablekit.operators import models, trees
from tablekit.plans import queries

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def points(spark):
    """Three features, one of them a category, and three classes."""
    rows = spark.range(600).select(
        "id", F.array((F.col("id") % 17).cast("double"), (F.col("id") * 7 % 101 / 10), (F.col("id") % 4).cast("double"))
        .alias("v"))
    rows = rows.withColumn("label", F.when(F.col("v")[2] == 2, 2.0).when(F.col("v")[0] + F.col("v")[1] > 12, 1.0)
                           .otherwise(0.0))
    from pyspark.ml.functions import array_to_vector
    rows = rows.withColumn("raw", array_to_vector("v"))
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=4).fit(rows).transform(rows).select(
        "id", "label", "features", vector_to_array("features").alias("v")).cache()


def test_tree_rows_rules_and_walk(spark, points):
    model = models.decision_tree(points, max_depth=4)
    nodes = trees.tree_nodes(spark, model)
    rows = {r["path"]: r for r in nodes.collect()}
    assert len(rows) == model.numNodes and max(map(len, rows)) == model.depth
    assert any(r["categories"] for r in rows.values()) and any(r["threshold"] is not None for r in rows.values())
    for path, r in rows.items():
        if r["feature"] is None:
            assert path + "L" not in rows
        else:
            assert rows[path + "L"]["n"] + rows[path + "R"]["n"] == r["n"]
            assert rows[path + "L"]["parent"] == rows[path + "R"]["parent"] == r["node"]
    told = model.transform(points).select(
        "id", "prediction", trees.rule_column(nodes, [F.col("v")[i] for i in range(3)]).alias("rule"),
        trees.rule_column(nodes, [F.col("v")[i] for i in range(3)], "path").alias("leaf"))
    assert told.where("prediction <> rule").isEmpty()
    assert told.select("prediction").distinct().count() == 3  # no constant answer
    walked = trees.leaves_by_join(points.select("id", "v"), nodes, "v")
    assert walked.join(told.withColumnRenamed("prediction", "p"), "id").where("prediction <> p or path <> leaf").isEmpty()
    assert walked.count() == points.count()
    assert "Python" not in told._jdf.queryExecution().executedPlan().toString()


def test_a_single_leaf(spark, points):
    one = points.withColumn("label", F.lit(1.0))
    nodes = trees.tree_nodes(spark, models.decision_tree(one))
    assert [(r["path"], r["feature"], r["prediction"]) for r in nodes.collect()] == [("", None, 1.0)]
    assert trees.leaves_by_join(points.select("id", "v"), nodes, "v").where("prediction = 1").count() == points.count()


def test_regression_trees_have_rows_too(spark, points):
    from pyspark.ml.regression import DecisionTreeRegressor
    model = DecisionTreeRegressor(maxDepth=3, seed=1).fit(points)
    nodes = trees.tree_nodes(spark, model)
    rule = trees.rule_column(nodes, [F.col("v")[i] for i in range(3)])
    assert model.transform(points).where(F.abs(rule - F.col("prediction")) > 1e-12).isEmpty()


def test_forest_votes(spark, points):
    model = models.random_forest(points, num_trees=7, max_depth=3)
    nodes = trees.tree_nodes(spark, model)
    assert nodes.select("tree").distinct().count() == 7 and nodes.count() == model.totalNumNodes
    votes = trees.forest_votes(points, nodes, "v", ["id"]).withColumnRenamed("prediction", "voted")
    both = model.transform(points).join(votes, "id")
    assert both.count() == points.count() and both.where("prediction <> voted").isEmpty()
    assert both.where(F.abs(F.array_max(vector_to_array("rawPrediction")) - F.col("share")) > 1e-9).isEmpty()


def test_model_outputs(spark):
    """The queries that return what models give, against the models' relations."""
    q = queries()
    found = q["forest_predictions"](spark, SF_SMALL)
    assert found.where("prediction <> voted or share > 1 or share < 0.25").isEmpty()
    centres = {r["cluster"]: r for r in q["kmeans_centres"](spark, SF_SMALL).groupBy("cluster").agg(
        F.count("*").alias("n"), F.first("rows").alias("rows")).collect()}
    clusters = q["kmeans_clusters"](spark, SF_SMALL)
    assert {r["cluster"]: r["n"] for r in clusters.groupBy("cluster").agg(F.count("*").alias("n")).collect()} == \
        {k: r["rows"] for k, r in centres.items()} and all(r["n"] == 64 for r in centres.values())
    points = q["cluster_points"](spark, SF_SMALL).join(clusters.withColumnRenamed("cluster", "c"), "vec_id")
    assert points.count() == clusters.count() and points.where("cluster <> c").isEmpty()
    users = q["als_user_factors"](spark, SF_SMALL)
    ids = [r["id"] for r in users.select("id").collect()]
    assert ids == sorted(ids) and users.where("size(features) <> 10").isEmpty()
    rated = q["als_predictions"](spark, SF_SMALL)
    assert rated.where("not isnan(prediction)").select(F.abs(F.col("prediction") - F.col("rating")).alias("e")).count() > 0
