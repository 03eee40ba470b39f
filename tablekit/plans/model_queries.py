"""Queries that return what models give: rules, predictions, votes, factors, clusters.

They stand beside the queries that state checkable facts about the same models.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..operators import evaluate, features, models, relational, sparse_text, trees
from . import model_oracles as sql
from .queries import T, _als, _embeddings, _kmeans_predictions, _labelled_docs, query

ORACLES = {"hashed_tf": sql.HASHED_TF_SQL, "text_nb": sql.TEXT_NB_SQL,
           "text_nb_sparse": f"SELECT doc_id, prediction FROM ({sql.TEXT_NB_SQL})", "tree_rules": sql.TREE_RULES_SQL,
           "tree_predictions": sql.TREE_PREDICTIONS_SQL, "forest_votes": sql.FOREST_SQL}


# ---------------------------------------------------------------- hashed text

@query("hashed_tf")
def q_hashed_tf(spark, sf_dir):
    """H3: every document's hashed term frequencies as sparse rows."""
    return sparse_text.hashed_tf(T(spark, sf_dir, "documents", heavy=True), "doc_id", "text")


@query("text_nb")
def q_text_nb(spark, sf_dir):
    """Tokenizer -> HashingTF -> IDF -> NaiveBayes pipeline, 90/10 split: the
    held-out rows with their tokens and the pipeline's prediction."""
    docs = _labelled_docs(spark, sf_dir)
    train, test = relational.hash_split(docs, ["doc_id"], [0.9, 0.1])
    model = features.fit_pipeline(features.tfidf_stages("text") + [models.naive_bayes()], train)
    total = F.aggregate(vector_to_array("__tf"), F.lit(0.0), lambda a, x: a + x)
    return model.transform(test).select("doc_id", "label", total.cast("bigint").alias("tokens"), "prediction")


@query("text_nb_sparse")
def q_text_nb_sparse(spark, sf_dir):
    """The same model fitted and scored on sparse (document, bucket, weight)
    rows: two grouped sums, and one join on the bucket per document."""
    train, test = relational.hash_split(_labelled_docs(spark, sf_dir), ["doc_id"], [0.9, 0.1])
    learnt = sinks.cut_lineage(sparse_text.hashed_tf(train, "doc_id", "text", keep=["label"]))
    m = train.where("text is not null").count()
    idf = sinks.cut_lineage(sparse_text.bucket_idf(learnt, F.lit(m)))

    def weighted(tf: DataFrame) -> DataFrame:
        # A bucket of no training document has the largest weight, ln(m + 1).
        both = sparse_text.join_buckets(tf, idf, "doc_id", 16, sql.BUCKETS)
        return both.withColumn("weight", F.col("tf") * F.coalesce("idf", F.log(F.lit(m + 1.0))))
    fitted = sparse_text.fit_sparse_naive_bayes(weighted(learnt), train)
    return fitted.score(weighted(sparse_text.hashed_tf(test, "doc_id", "text")), test, "doc_id").drop("scores")


# ---------------------------------------------------------------- trees

def _language_features(spark, sf_dir) -> DataFrame:
    """``(doc_id, lang, label, v array<double>, features vector)``: how often some letters
    stand in a text, and the language by descending frequency."""
    docs = T(spark, sf_dir, "documents", heavy=True).where("lang is not null and text is not null")
    size = F.greatest(F.length("text"), F.lit(1))
    values = [F.least(F.lit(sql.MOST), F.floor(F.floor(
        (F.length("text") - F.length(F.replace("text", F.lit(x)))) / len(x)) * sql.STEPS / size)).cast("double")
        for x in sql.LETTERS]
    rows = docs.select("doc_id", "lang", F.array(*values).alias("v"))
    return features.string_index(rows, "lang", "label")[0].withColumn(
        "features", array_to_vector(F.col("v")))


def _language_split(spark, sf_dir) -> list[DataFrame]:
    rows = _language_features(spark, sf_dir).select("doc_id", "label", "v", "features")
    return relational.hash_split(rows, ["doc_id"], [0.9, 0.1])


@query("tree_rules")
def q_tree_rules(spark, sf_dir):
    """A depth-2 language tree as its node rows: features, thresholds,
    predictions and training rows per node."""
    train, _ = _language_split(spark, sf_dir)
    nodes = trees.tree_nodes(spark, models.decision_tree(train, max_depth=sql.DEPTH))
    return nodes.select("path", "feature", "threshold", "prediction", "n")


@query("tree_predictions")
def q_tree_predictions(spark, sf_dir):
    """Held-out predictions of that tree three ways: the model, its rules as one
    expression, and the rows walking the node table by joins."""
    train, test = _language_split(spark, sf_dir)
    model = models.decision_tree(train, max_depth=sql.DEPTH)
    nodes = trees.tree_nodes(spark, model)
    columns = [F.col("v")[i] for i in range(len(sql.LETTERS))]
    told = model.transform(test).select("doc_id", "label", "v", "prediction",
                                        trees.rule_column(nodes, columns).alias("rule_prediction"))
    walked = trees.leaves_by_join(test.select("doc_id", "v"), nodes, "v")
    return told.drop("v").join(walked.select("doc_id", "path", F.col("prediction").alias("walked_prediction")), "doc_id")


def _forest(spark, sf_dir):
    train, test = _language_split(spark, sf_dir)
    model = models.random_forest(train)
    votes = trees.forest_votes(test, trees.tree_nodes(spark, model), "v", ["doc_id"])
    return model.transform(test).join(votes.select("doc_id", F.col("prediction").alias("voted"), "share"), "doc_id")


@query("forest_predictions")
def q_forest_predictions(spark, sf_dir):
    """A language forest's held-out predictions, with the prediction that its trees'
    leaves vote for and the winner's share of the votes."""
    share = F.round(F.col("share") / 20, 6).alias("share")
    return _forest(spark, sf_dir).select("doc_id", "label", "prediction", "voted", share)


@query("forest_votes")
def q_forest_votes(spark, sf_dir):
    """Per held-out row whether the votes of the node rows give the forest's
    prediction, and whether the forest beats every constant prediction."""
    found = _forest(spark, sf_dir).select("doc_id", "label", "prediction", "voted")
    share = relational.count_by_key(found, "label").agg(F.max("n") / F.sum("n")).scalar()
    better = evaluate.accuracy(found).select(F.col("accuracy") > share).scalar()
    return found.select("doc_id", "label", (F.col("prediction") == F.col("voted")).alias("votes_agree"),
                        better.alias("beats_constant"))


# ---------------------------------------------------------------- clusters and factors

@query("kmeans_clusters")
def q_kmeans_clusters(spark, sf_dir):
    """Every row's cluster and its distance from the cluster's centre."""
    pred, centres = _kmeans_predictions(spark, sf_dir)
    x = vector_to_array("features")
    apart = F.array(*[F.sqrt(F.aggregate(F.zip_with(x, F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)),
                                         F.lit(0.0), lambda a, d: a + d)) for c in centres])
    return pred.select("vec_id", F.col("prediction").alias("cluster"),
                       F.round(apart[F.col("prediction")], 6).alias("distance"))


@query("kmeans_centres")
def q_kmeans_centres(spark, sf_dir):
    """The centres, one row per cluster and dimension, with the clusters' rows."""
    pred, centres = _kmeans_predictions(spark, sf_dir)
    table = spark.createDataFrame([(k, c) for k, c in enumerate(centres)], "cluster int, centre array<double>")
    sizes = relational.count_by_key(pred.withColumnRenamed("prediction", "cluster"), "cluster")
    return table.join(sizes, "cluster", "left").select("cluster", F.coalesce("n", F.lit(0)).alias("rows"),
                                                       F.posexplode("centre").alias("dimension", "value"))


@query("cluster_points")
def q_cluster_points(spark, sf_dir):
    """(cluster, x, y) per row: what the scatter plot draws."""
    pred, _ = _kmeans_predictions(spark, sf_dir)
    return models.cluster_scatter(pred, keep=["vec_id"])


@query("als_user_factors")
def q_als_user_factors(spark, sf_dir):
    """The users' factors in order of the ids, under the users' keys."""
    model, train, _ = _als(spark, sf_dir)
    keys = train.select("o_custkey", F.col("user").alias("id")).distinct()
    return model.userFactors.join(keys, "id").select("id", "o_custkey", "features").orderBy("id")


@query("als_predictions")
def q_als_predictions(spark, sf_dir):
    """Held-out pairs with rating and prediction (NaN for a key without training rows)."""
    model, _, test = _als(spark, sf_dir)
    return model.transform(test).select("o_custkey", "l_partkey", "rating", "prediction")
