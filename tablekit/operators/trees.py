"""Fitted trees as tables and as expressions.

A decision tree or forest becomes rows, one per node, and from these rows a
plain Column, a relational walk (vectors joined with the node rows) or the votes
of a forest. All three give the predictions of the model's own ``transform``.

The model is on the driver, so its nodes are as well: the node table has at most
``trees * 2^(depth + 1)`` rows and is read from the model's saved form.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

NODES = ("tree int, node int, parent int, path string, depth int, feature int, threshold double, "
         "categories array<double>, left int, right int, prediction double, n bigint, impurity double, "
         "gain double, votes array<double>")
_TYPES = {"int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(),
          "array<double>": pa.list_(pa.float64())}
ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in NODES.split(", ")])


def tree_nodes(spark: SparkSession, model) -> DataFrame:
    """I4: the node table of a fitted tree or forest model.

    ``path`` spells the way from the root ('' for the root, then L or R). An inner
    node has ``feature`` and, if that is continuous, ``threshold`` (left: value <=
    threshold) or else ``categories`` (left: value is one of them); a leaf has
    neither. ``votes`` are a classifier's class shares; ``n`` counts training rows.
    """
    saved = scratch_path(spark, "tree_model")
    model.save(saved)
    data = spark.read.parquet(f"{saved}/data")
    if "nodeData" in data.columns:  # a forest's rows name their tree
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    found = {(r["tree"], r["id"]): r for r in data.collect()}  # on the driver already, as the model
    rows: list[tuple] = []

    def add(tree: int, node: int, parent: int | None, path: str) -> None:
        r = found[tree, node]
        split, inner = r["split"], r["leftChild"] >= 0
        values = [float(v) for v in split["leftCategoriesOrThreshold"]] if inner else []
        continuous = inner and split["numCategories"] < 0
        total = float(sum(r["impurityStats"]))
        rows.append((tree, node, parent, path, len(path), int(split["featureIndex"]) if inner else None,
                     values[0] if continuous else None, values if inner and not continuous else None,
                     r["leftChild"] if inner else None, r["rightChild"] if inner else None, float(r["prediction"]),
                     int(r["rawCount"]), float(r["impurity"]), float(r["gain"]) if inner else None,
                     [float(x) / total for x in r["impurityStats"]] if total else None))
        if inner:
            add(tree, r["leftChild"], node, path + "L")
            add(tree, r["rightChild"], node, path + "R")
    for tree in sorted({t for t, _ in found}):
        add(tree, 0, None, "")
    return spark.createDataFrame(pa.Table.from_pylist([dict(zip(ARROW.names, r)) for r in rows], ARROW), NODES)


def _goes_left(feature: Column, threshold: Column, categories: Column) -> Column:
    return F.when(categories.isNull(), feature <= threshold).otherwise(F.array_contains(categories, feature))


def rule_column(nodes: DataFrame, features: list[Column], value: str = "prediction", tree: int = 0) -> Column:
    """I4: one tree as nested conditions over feature columns: code-generated, no join.

    ``value`` is the node column a leaf gives (``prediction`` or ``path``).
    """
    by_id = {r["node"]: r for r in nodes.where(F.col("tree") == tree).collect()}

    def rule(node: int) -> Column:
        r = by_id[node]
        if r["feature"] is None:
            return F.lit(r[value])
        x = features[r["feature"]]
        left = x <= r["threshold"] if r["categories"] is None else x.isin(r["categories"])
        return F.when(left, rule(r["left"])).otherwise(rule(r["right"]))
    return rule(0)


def leaves_by_join(rows: DataFrame, nodes: DataFrame, features: str) -> DataFrame:
    """Every row's leaf in every tree, by walking the node table with joins.

    ``features`` is an ``array<double>`` column. Each step joins the rows' current
    nodes with the node rows; the number of steps is the model's depth. Gives the
    columns of ``rows`` with ``tree``, ``path``, ``prediction`` and ``votes``.
    """
    names = ["tree", "node", "feature", "threshold", "categories", "left", "right", "path", "prediction", "votes"]
    step = nodes.select(*[F.col(c).alias(f"__{c}") for c in names])
    trees, depth = nodes.agg(F.max("tree") + 1, F.max("depth")).first()
    walk = rows.withColumn("__tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("__node", F.lit(0))
    keep = [*rows.columns, "__tree"]
    for _ in range(depth):
        at = walk.join(F.broadcast(step), ["__tree", "__node"])  # the model's own size
        x = F.element_at(F.col(features), F.col("__feature") + 1)
        left = _goes_left(x, F.col("__threshold"), F.col("__categories"))
        walk = at.select(*keep, F.when(F.col("__feature").isNull(), F.col("__node"))
                         .when(left, F.col("__left")).otherwise(F.col("__right")).alias("__node"))
    done = walk.join(F.broadcast(step), ["__tree", "__node"])
    return done.select(*rows.columns, *[F.col(f"__{c}").alias(c) for c in ("tree", "path", "prediction", "votes")])


def forest_votes(rows: DataFrame, nodes: DataFrame, features: str, key: list[str]) -> DataFrame:
    """A forest's prediction from its node rows: the trees' leaf shares summed per
    class, the highest sum wins (the lower class on a tie)."""
    votes = leaves_by_join(rows.select(*key, features), nodes, features)
    per_class = (votes.select(*key, F.posexplode("votes").alias("class", "share"))
                 .groupBy(*key, "class").agg(F.sum("share").alias("share")))
    return per_class.groupBy(*key).agg(
        F.max_by("class", F.struct("share", -F.col("class"))).cast("double").alias("prediction"),
        F.max("share").alias("share"))
