"""Evaluation (J1-J3) as aggregations that stay DataFrames.

Each metric is one distributed aggregate (the ML evaluators return a float on
the driver; these return a one-row DataFrame, equal to the evaluator's value).
"""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import count_by_key


def accuracy(pred: DataFrame, label: str = "label", prediction: str = "prediction",
             out: str = "accuracy") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = (F.col(prediction).cast("double") == F.col(label).cast("double")).cast("double")
    return pred.agg(F.avg(hit).alias(out))


def r2(pred: DataFrame, label: str = "label", prediction: str = "prediction",
       out: str = "r2") -> DataFrame:
    """``1 - SS_res / SS_tot`` over the rows that have both values; null when
    there are none or the label is constant."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    both = pred.where(y.isNotNull() & p.isNotNull())
    stats = both.agg(F.sum((y - p) * (y - p)).alias("ss_res"),
                     F.var_pop(y).alias("v"), F.count(F.lit(1)).alias("n"))
    return stats.select((1 - F.try_divide("ss_res", F.col("v") * F.col("n"))).alias(out))


def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction)."""
    return count_by_key(pred, label, prediction)


def evaluator_accuracy(pred: DataFrame, label: str = "label",
                       prediction: str = "prediction") -> float:
    """J1 through Spark ML's evaluator (a driver-side float)."""
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol=prediction,
                                             metricName="accuracy").evaluate(pred)


def evaluator_r2(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """J2 through Spark ML's evaluator."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction,
                               metricName="r2").evaluate(pred)
