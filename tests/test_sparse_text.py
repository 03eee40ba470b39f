"""Sparse hashed text and naive Bayes against the ML stages."""

from __future__ import annotations

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, Tokenizer
from pyspark.sql import functions as F

from tablekit.operators import models, sparse_text

TEXTS = [(0, "a b c a", 0.0), (1, "", 0.0), (2, "  x y  ", 1.0), (3, "é 日本 🎉 ab abc abcd abcde", 1.0), (4, None, 1.0),
         (5, " ", 2.0), (6, "b b b b x", 2.0), (7, " ".join(f"w{i}" for i in range(3000)), 0.0), (8, "A B", 1.0)]


@pytest.mark.parametrize("buckets", [1 << 18, 7])
def test_hashed_rows_equal_the_stage(spark, buckets):
    docs = spark.createDataFrame(TEXTS, "id long, text string, label double")
    got = {(r["id"], r["bucket"]): r["tf"] for r in sparse_text.hashed_tf(docs, "id", "text", buckets).collect()}
    words = Tokenizer(inputCol="text", outputCol="w").transform(docs.where("text is not null"))
    want = {}
    for r in HashingTF(inputCol="w", outputCol="v", numFeatures=buckets).transform(words).collect():
        want |= {(r["id"], int(i)): int(x) for i, x in zip(r["v"].indices, r["v"].values)}
    assert got == want and (buckets > 7 or max(got.values()) > 400)  # collisions included


def test_unpacking_needs_no_shuffle(spark):
    docs = spark.createDataFrame(TEXTS, "id long, text string, label double")
    plan = sparse_text.hashed_tf(docs, "id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("buckets,limit", [(1 << 10, None), (5, None), (1 << 10, 0)])
def test_naive_bayes_equals_the_stages(spark, monkeypatch, buckets, limit):
    if limit is not None:
        monkeypatch.setattr(sparse_text, "BROADCAST_BYTES", limit)  # the join that is salted
    rows = [(i, " ".join(f"t{(i * k) % (11 + i % 3)}" for k in range(1, 2 + i % 9)), float(i % 3)) for i in range(90)]
    docs = spark.createDataFrame(rows, "id long, text string, label double")
    fresh = spark.createDataFrame([(1000, "t1 t2 new", 0.0), (1001, "never seen", 0.0), (1002, "t5", 0.0)], docs.schema)
    stages = [Tokenizer(inputCol="text", outputCol="w"), HashingTF(inputCol="w", outputCol="tf", numFeatures=buckets),
              IDF(inputCol="tf", outputCol="features"), models.naive_bayes()]
    both = docs.unionByName(fresh)
    model = Pipeline(stages=stages).fit(docs)
    want = {r["id"]: (r["prediction"], r["rawPrediction"].toArray().tolist()) for r in model.transform(both).collect()}
    m = docs.count()
    learnt = sparse_text.hashed_tf(docs, "id", "text", buckets, keep=["label"])
    idf = sparse_text.bucket_idf(learnt, F.lit(m))

    def weighted(tf):
        return sparse_text.join_buckets(tf, idf, "id", 16, buckets).withColumn(
            "weight", F.col("tf") * F.coalesce("idf", F.log(F.lit(m + 1.0))))
    fitted = sparse_text.fit_sparse_naive_bayes(weighted(learnt), docs, num_features=buckets)
    got = fitted.score(weighted(sparse_text.hashed_tf(both, "id", "text", buckets)), both, "id").collect()
    assert len(got) == len(want)
    for r in got:
        prediction, scores = want[r["id"]]
        assert r["prediction"] == prediction and r["scores"] == pytest.approx(scores, rel=1e-9)
    assert len({r["prediction"] for r in got}) > 1


def test_documents_without_words_get_the_prior(spark):
    docs = spark.createDataFrame([(0, "a", 1.0), (1, "b", 0.0), (2, "a", 1.0)], "id long, text string, label double")
    tf = sparse_text.hashed_tf(docs, "id", "text", 64, keep=["label"]).withColumn("weight", F.col("tf").cast("double"))
    fitted = sparse_text.fit_sparse_naive_bayes(tf, docs, num_features=64)
    empty = spark.createDataFrame([(9, None), (10, "zzz a")], "id long, text string")
    rows = sparse_text.hashed_tf(empty, "id", "text", 64).withColumn("weight", F.col("tf").cast("double"))
    got = {r["id"]: r for r in fitted.score(rows, empty, "id").collect()}
    assert got[9]["scores"] == fitted.priors and got[9]["prediction"] == 1.0 and len(got) == 2
