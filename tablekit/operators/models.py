"""Models (I1-I11): Spark ML estimators with fixed seeds and reports as DataFrames.

Training sets are persisted (memory and disk) around ``fit`` because every
iterative estimator rescans them; reports (coefficients, tree shape, factors)
are bounded by the number of features, nodes or ids, never by rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.classification import (DecisionTreeClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.literal import literal_table


def _fit(estimator, train: DataFrame):
    """Fit on a persisted training set; a frame the caller already keeps is
    used as it is (and left persisted)."""
    level = train.storageLevel
    if level.useMemory or level.useDisk:
        return estimator.fit(train)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


#: Rows of a training partition of trees: while a forest is fitted, each of its rows
#: takes some 200 bytes (20 trees, few features).
TREE_ROWS = 1 << 18


def _fit_trees(estimator, train: DataFrame):
    """As ``_fit``, on partitions that grow in number with the rows: trees keep every
    partition's rows as objects. A set with larger partitions is dealt anew."""
    level = train.storageLevel
    if level.useMemory or level.useDisk:
        return _fit_dealt(estimator, train)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _fit_dealt(estimator, train)
    finally:
        train.unpersist()


def _fit_dealt(estimator, kept: DataFrame):
    sizes = kept.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    rows, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= 2 * TREE_ROWS:
        return estimator.fit(kept)
    return _fit(estimator, kept.repartition(-(-rows // TREE_ROWS)))


# ---- I1/I2 linear regression -------------------------------------------------------

def linear_regression(train: DataFrame, features: str = "features", label: str = "label",
                      max_iter: int = 200, reg_param: float = 0.0):
    """Least squares (normal equations up to 4096 features, else L-BFGS)."""
    return _fit(LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                                 regParam=reg_param), train)


def regression_report(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """Coefficients and intercept as a table ``(term, value)``."""
    rows = [(n, float(v)) for n, v in zip(names, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return literal_table(spark, rows, "term string, value double")


# ---- I3/I4 decision tree, I5 random forest ---------------------------------------

def decision_tree(train: DataFrame, features: str = "features", label: str = "label",
                  max_depth: int = 2, seed: int = 42):
    """Classification tree of a fixed depth."""
    return _fit_trees(DecisionTreeClassifier(featuresCol=features, labelCol=label,
                                             maxDepth=max_depth, seed=seed), train)


def tree_report(spark: SparkSession, model) -> DataFrame:
    """I4: node count, depth and the printed rules, one row."""
    return literal_table(spark, [(int(model.numNodes), int(model.depth),
                                  model.toDebugString)],
                         "num_nodes int, depth int, rules string")


def random_forest(train: DataFrame, features: str = "features", label: str = "label",
                  num_trees: int = 20, max_depth: int = 5, seed: int = 42):
    """Random forest (Spark defaults: 20 trees of depth 5)."""
    return _fit_trees(RandomForestClassifier(featuresCol=features, labelCol=label,
                                             numTrees=num_trees, maxDepth=max_depth,
                                             seed=seed), train)


# ---- I6 naive Bayes ---------------------------------------------------------------

def naive_bayes(smoothing: float = 1.0, features: str = "features",
                label: str = "label") -> NaiveBayes:
    """Multinomial naive Bayes stage (to be fitted in a pipeline)."""
    return NaiveBayes(featuresCol=features, labelCol=label, smoothing=smoothing,
                      modelType="multinomial")


def naive_bayes_params(spark: SparkSession, model, feature_names: list[str]) -> DataFrame:
    """Log priors and log conditionals of a fitted NB model, long form
    ``(label, feature, log_prior, log_theta)``; size classes x features."""
    pi = model.pi.toArray()
    theta = model.theta.toArray()
    labels = [float(i) for i in range(len(pi))]
    rows = [(labels[k], feature_names[j], float(pi[k]), float(theta[k, j]))
            for k in range(len(pi)) for j in range(len(feature_names))]
    return literal_table(spark, rows, "label double, feature string, log_prior double, "
                                      "log_theta double")


# ---- I7/I11 k-means ---------------------------------------------------------------

def kmeans(train: DataFrame, k: int = 5, seed: int = 1, features: str = "features",
           max_iter: int = 20):
    """K-means (k-means|| initialisation, fixed seed)."""
    return _fit(KMeans(k=k, seed=seed, featuresCol=features, maxIter=max_iter), train)


def cluster_scatter(predictions: DataFrame, features: str = "features",
                    keep: list[str] | None = None) -> DataFrame:
    """The data behind the scatter plot: ``(cluster, x, y)`` per row.

    Stays distributed; a plotting client reads it from a sink.
    """
    arr = vector_to_array(features)
    return predictions.select(*(keep or []), F.col("prediction").alias("cluster"),
                              arr.getItem(0).alias("x"), arr.getItem(1).alias("y"))


# ---- I8-I10 ALS ---------------------------------------------------------------------

#: Hash buckets that number distinct keys side by side.
ID_BUCKETS = 1024


def dense_ids(df: DataFrame, col: str, out: str) -> tuple[DataFrame, DataFrame]:
    """ALS needs 32-bit ids: number the distinct keys of ``col`` from 0.

    One path for every key type and range: distinct keys are numbered by their
    order within hash buckets, each bucket starting where the one before ends
    (sizes of ``ID_BUCKETS`` buckets are a bounded table). The numbering depends
    on the keys alone: computed again, on any partitioning, it is the same. Null
    keys stay, with a null id. Returns the frame with ``out`` and the mapping ``(col, out)``.
    """
    keys = (df.select(col).where(F.col(col).isNotNull()).distinct()
              .withColumn("__b", F.pmod(F.xxhash64(col), F.lit(ID_BUCKETS))))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = (keys.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
                  .select("__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    rank = F.row_number().over(Window.partitionBy("__b").orderBy(col))
    mapping = (keys.join(F.broadcast(starts), "__b")
                   .select(col, (F.col("__start") + rank - 1).cast("int").alias(out)))
    return df.join(mapping, col, "left"), mapping


def als(train: DataFrame, user: str = "user", item: str = "item", rating: str = "rating",
        rank: int = 10, max_iter: int = 5, reg_param: float = 0.1, seed: int = 42,
        blocks: int = 10):
    """I8: explicit-feedback ALS; unknown ids predict NaN (cold start ``nan``).

    ALS caches its own user/item rating blocks, so the input is not persisted
    again here. ``blocks`` (Spark's default) is part of the model: the same data
    and seed give the same factors on any cluster. Rows with a null id are left out.
    """
    train = train.where(F.col(user).isNotNull() & F.col(item).isNotNull())
    return ALS(rank=rank, maxIter=max_iter, regParam=reg_param, userCol=user, itemCol=item,
               ratingCol=rating, seed=seed, coldStartStrategy="nan",
               numUserBlocks=blocks, numItemBlocks=blocks).fit(train)


def factors(model, which: str = "user") -> DataFrame:
    """Factor table ``(id, features array<float>)`` sorted by id."""
    f = model.userFactors if which == "user" else model.itemFactors
    return f.orderBy("id")
