from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablekit.functions import assemble
from tablekit.operators import evaluate, features, models
from tablekit.plans import queries

from conftest import SF_SMALL


def test_linear_regression_residuals_orthogonal(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 5 + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)],
                               "x1 double, x2 double, label double")
    v = assemble(df, ["x1", "x2"])
    m = models.linear_regression(v)
    p = m.transform(v)
    res = p.select((F.col("label") - F.col("prediction")).alias("r"), "x1", "x2")
    s = res.agg(F.sum("r"), F.sum(F.col("r") * F.col("x1")), F.sum(F.col("r") * F.col("x2")))
    assert all(abs(v) < 1e-6 for v in s.first())
    ours = evaluate.r2(p).first().r2
    assert math.isclose(ours, evaluate.evaluator_r2(p), rel_tol=1e-9)
    rep = {r.term: r.value for r in models.regression_report(spark, m, ["x1", "x2"]).collect()}
    assert abs(rep["x1"] - 3) < 0.05 and abs(rep["intercept"] - 5) < 0.05


def test_decision_tree_shape_bound(spark):
    r = queries()["tree_report"](spark, SF_SMALL).first()
    assert r.depth_ok and r.nodes_ok and r.rules_ok


def test_accuracy_equals_evaluator(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (2.0, 2.0)],
                               "label double, prediction double")
    assert math.isclose(evaluate.accuracy(df).first().accuracy,
                        evaluate.evaluator_accuracy(df), rel_tol=1e-12)
    conf = {(r.label, r.prediction): r.n for r in evaluate.confusion(df).collect()}
    assert conf[(1.0, 0.0)] == 1


def test_kmeans_rows_are_assigned_to_nearest_centre(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(loc=c, scale=0.2, size=(30, 2)) for c in [(0, 0), (5, 5), (0, 5)]])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pts], "x double, y double")
    v = assemble(df, ["x", "y"])
    m = models.kmeans(v, k=3, seed=1)
    centres = np.array([c for c in m.clusterCenters()])
    for r in models.cluster_scatter(m.transform(v)).collect():
        d = ((centres - np.array([r.x, r.y])) ** 2).sum(axis=1)
        assert int(np.argmin(d)) == r.cluster


def test_als_prediction_is_factor_dot_product_and_unseen_is_nan(spark):
    rows = [(u, i, float((u * 3 + i) % 5 + 1)) for u in range(1, 7) for i in range(1, 9)
            if (u + i) % 3]
    df = spark.createDataFrame(rows, "user int, item int, rating float")
    m = models.als(df, rank=3, max_iter=5)
    uf = {r.id: np.array(r.features) for r in models.factors(m, "user").collect()}
    itf = {r.id: np.array(r.features) for r in models.factors(m, "item").collect()}
    test = spark.createDataFrame([(1, 2), (7777, 2)], "user int, item int")
    got = {r.user: r.prediction for r in m.transform(test).collect()}
    assert math.isclose(got[1], float(uf[1] @ itf[2]), rel_tol=1e-5)
    assert math.isnan(got[7777])


@pytest.mark.parametrize("kind,keys", [("long", [2**40, 5, -3, 2**62, 7]), ("string", ["a", "b", "", "zz", "é"])])
def test_dense_ids_number_any_key(spark, kind, keys):
    df = spark.createDataFrame([(k, 1.0) for k in keys + keys[:2]] + [(None, 9.0)], f"k {kind}, v double")
    out, mapping = models.dense_ids(df, "k", "kid")
    ids = {r.k: r.kid for r in out.collect()}
    assert out.count() == 8 and ids.pop(None) is None
    assert sorted(ids.values()) == [0, 1, 2, 3, 4] and mapping.count() == 5
    again, _ = models.dense_ids(df.repartition(5), "k", "kid")
    assert {r.k: r.kid for r in again.collect() if r.k is not None} == ids


def test_als_does_not_depend_on_partitions(spark):
    rows = [(u, i, float((u * 3 + i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows + [(None, 1, 2.0)], "user int, item int, rating float")
    got = []
    for parts in (2, 7):
        m = models.als(df.repartition(parts, "user", "item").sortWithinPartitions("user", "item"), rank=2, max_iter=3)
        got.append({r.user: r.prediction for r in m.transform(df.where("item = 1 and user is not null")).collect()})
    assert got[0].keys() == got[1].keys() and all(math.isclose(v, got[1][k], rel_tol=1e-3) for k, v in got[0].items())


def test_r2_uses_complete_rows_and_constant_label_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (4.0, None), (None, 3.0)], "label double, prediction double")
    assert math.isclose(evaluate.r2(df).first().r2, 0.0)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert evaluate.r2(flat).first().r2 is None


def test_naive_bayes_flags_formula(spark):
    r = {(x.label, x.feature): x for x in queries()["nb_flags"](spark, SF_SMALL).collect()}
    labels = {k[0] for k in r}
    # conditionals of each class sum to one in probability space
    for lab in labels:
        total = sum(math.exp(x.log_theta) for (l_, _), x in r.items() if l_ == lab)
        assert math.isclose(total, 1.0, rel_tol=1e-6)


def test_pipeline_text_nb_runs(spark):
    df = queries()["text_nb"](spark, SF_SMALL)
    assert set(df.columns) == {"doc_id", "label", "tokens", "prediction"}
    assert df.where("prediction not in (0.0, 1.0) or tokens < 1").count() == 0


def test_random_forest_pca_predicts_known_labels(spark):
    df = queries()["random_forest_pca"](spark, SF_SMALL)
    assert df.count() > 0
    assert df.where("not in_classes").count() == 0


def test_pca_transform_array(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 5.0)], "x double, y double")
    v = assemble(df, ["x", "y"])
    m = features.fit_pca(v, "features", 1)
    out = features.pca_transform_array(m, v)
    assert len(out.first().pca) == 1
