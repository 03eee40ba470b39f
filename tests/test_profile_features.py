from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import CountVectorizer, IDF, StandardScaler
from pyspark.ml.functions import vector_to_array

from tablekit.functions import assemble, unpack
from tablekit.operators import features, profile
from tablekit.plans.explain import plan_text


def frame(spark):
    rows = [(float(i), float((i * 7) % 11), 3.0, float(i % 3)) for i in range(40)]
    return spark.createDataFrame(rows, "a double, b double, k double, c double")


def test_summary_matches_describe(spark):
    df = frame(spark)
    ours = {r.column: r for r in profile.summary_stats(df, ["a", "b"]).collect()}
    desc = {r.summary: r for r in df.describe("a", "b").collect()}
    for c in ["a", "b"]:
        assert ours[c]["count"] == int(desc["count"][c])
        assert math.isclose(ours[c]["mean"], float(desc["mean"][c]), rel_tol=1e-12)
        assert math.isclose(ours[c]["stddev"], float(desc["stddev"][c]), rel_tol=1e-12)
        assert ours[c]["min"] == desc["min"][c] and ours[c]["max"] == desc["max"][c]


def test_summary_of_text_and_large_integers(spark):
    df = spark.createDataFrame([("b", 2**53 + 1, None), ("a", 1, 2.5), (None, None, None)], "s string, n long, d double")
    got = {r.column: r for r in profile.summary_stats(df, df.columns).collect()}
    assert (got["s"]["count"], got["s"]["mean"], got["s"]["min"], got["s"]["max"]) == (2, None, "a", "b")
    assert got["n"]["max"] == str(2**53 + 1) and got["d"]["count"] == 1 and got["d"]["min"] == "2.5"


def test_correlation_uses_rows_with_both_values(spark):
    df = spark.createDataFrame([(1.0, 0.5), (2.0, 1.0), (3.0, 1.5), (100.0, None), (None, -50.0)], "x double, y double")
    got = {r.column: r.corr for r in profile.corr_with_target(df, "x", ["y"]).collect()}
    assert math.isclose(got["y"], 1.0)


def test_pca_rejects_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        features.fit_pca_columns(df, ["a", "b"], 1)


def test_tf_idf_reads_the_text_once(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "b c"), (3, None), (4, "")], "i long, t string")
    out = features.tf_idf_table(df, "i", "t")
    assert "split(" not in plan_text(out)  # both sides read the written term counts
    got = {(r.i, r.term): (r.tf, r.df) for r in out.collect()}
    assert got == {(1, "a"): (2, 1), (1, "b"): (1, 2), (2, "b"): (1, 2), (2, "c"): (1, 1), (4, ""): (1, 1)}


def test_corr_matches_stat_corr_and_constant_is_nan(spark):
    df = frame(spark)
    got = {r.column: r.corr for r in profile.corr_with_target(df, "a", ["b", "c", "k"]).collect()}
    assert math.isclose(got["b"], df.stat.corr("a", "b"), rel_tol=1e-12)
    assert math.isclose(got["c"], df.stat.corr("a", "c"), rel_tol=1e-12)
    assert math.isnan(got["k"])  # constant column: NaN, not an error


def test_center_scale_equals_standard_scaler(spark):
    df = frame(spark)
    ours = profile.center_scale(df, ["a", "b"], keep=["c"]).orderBy("a").collect()
    v = assemble(df, ["a", "b"])
    ml = (StandardScaler(inputCol="features", outputCol="s", withMean=True, withStd=True)
          .fit(v).transform(v))
    ml_rows = unpack(ml, "s", ["a", "b"]).orderBy("a").collect()
    for x, y in zip(ours, ml_rows):
        assert math.isclose(x.a, y.a, abs_tol=1e-12) and math.isclose(x.b, y.b, abs_tol=1e-12)


def test_string_index_ties_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "s string")
    out, _ = features.string_index(df, "s", "i")
    assert {r.s: r.i for r in out.collect()} == {"c": 0.0, "a": 1.0, "b": 2.0}


def test_tf_idf_table_equals_spark_ml_idf(spark):
    docs = spark.createDataFrame([(1, "The cat sat"), (2, "the dog"), (3, "a cat a dog")],
                                 "id int, text string")
    table = {(r.id, r.term): r for r in features.tf_idf_table(docs, "id", "text").collect()}
    tok = features.tokenize(docs, "text", "words")
    cv = CountVectorizer(inputCol="words", outputCol="tf").fit(tok)
    idf = IDF(inputCol="tf", outputCol="x").fit(cv.transform(tok))
    vocab = cv.vocabulary
    for (i, term), r in table.items():
        assert math.isclose(r.idf, float(idf.idf[vocab.index(term)]), rel_tol=1e-12)
    assert table[(3, "a")].tf == 2


def test_pca_sign_fixed_orthonormal_and_equal_to_model(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 3)) @ np.array([[2, 0.5, 0], [0, 1, 0.3], [0, 0, 0.2]])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "x double, y double, z double")
    v = assemble(df, ["x", "y", "z"])
    model = features.fit_pca(v, "features", 2)
    comps = np.array(features.pca_sign_fixed(model))
    assert np.allclose(comps @ comps.T, np.eye(2), atol=1e-10)
    for c in comps:
        assert c[np.argmax(np.abs(c))] > 0
    ours = features.pca_project(df, ["x", "y", "z"], comps.tolist()).collect()
    theirs = model.transform(v).select(vector_to_array("__pca").alias("p")).collect()
    for a, b in zip(ours, theirs):
        for j in range(2):
            assert math.isclose(abs(a[j]), abs(b.p[j]), rel_tol=1e-9, abs_tol=1e-9)


def test_vector_round_trip(spark):
    df = frame(spark)
    back = unpack(assemble(df, ["a", "b"]), "features", ["a2", "b2"], keep=["a", "b"])
    assert all(r.a == r.a2 and r.b == r.b2 for r in back.collect())


def test_pca_columns_equals_spark_ml_pca(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) @ rng.normal(size=(4, 4))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    ours = np.array(features.fit_pca_columns(df, ["a", "b", "c", "d"], 3))
    model = features.fit_pca(assemble(df, ["a", "b", "c", "d"]), "features", 3)
    theirs = np.array(features.pca_sign_fixed(model))
    assert np.allclose(ours, theirs, atol=1e-9)
