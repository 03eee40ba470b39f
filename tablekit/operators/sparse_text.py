"""Hashed text features as sparse rows, and naive Bayes over them.

A document is ``(id, bucket, tf)`` rows, as ``HashingTF`` counts them, collisions
included. Fitting is two grouped sums and scoring one join on the bucket, so
neither needs a dense ``classes x 2^18`` matrix on the driver. Both give what the
ML stages (HashingTF, IDF, NaiveBayes) give.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lower_tokens
from ..sinks import cut_lineage
from .features import SALTS

#: Bytes up to which a bucket table is broadcast: buckets * classes * 8.
BROADCAST_BYTES = 32 << 20


def hashed_tf(df: DataFrame, id_col: str, text_col: str, num_features: int = 1 << 18,
              keep: list[str] | None = None) -> DataFrame:
    """H3: ``(id_col, *keep, bucket int, tf bigint)``, one row per document and bucket.

    The hash is ``HashingTF``'s own: its sparse vector is unpacked in place, row by
    row, without a shuffle. Null texts have no rows.
    """
    words = (df.where(F.col(text_col).isNotNull())
             .select(id_col, *(keep or []), lower_tokens(text_col).alias("__words")))
    vectors = HashingTF(inputCol="__words", outputCol="__v", numFeatures=num_features).transform(words)
    sparse = F.unwrap_udt("__v")
    return (vectors.select(id_col, *(keep or []), F.explode(F.arrays_zip(
                sparse["indices"].alias("bucket"), sparse["values"].alias("tf"))).alias("__x"))
            .select(id_col, *(keep or []), F.col("__x.bucket").alias("bucket"), F.col("__x.tf").cast("bigint").alias("tf")))


def bucket_idf(tf: DataFrame, documents: Column) -> DataFrame:
    """H4: ``(bucket, idf)`` with ``ln((m + 1) / (df + 1))`` over ``documents`` documents."""
    df = tf.groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    return df.select("bucket", F.log((documents + 1) / (F.col("df") + 1)).alias("idf"))


def join_buckets(rows: DataFrame, table: DataFrame, id_col: str, row_bytes: int, num_features: int) -> DataFrame:
    """``rows`` with a bucket table's columns (null where it has no row).

    The table has at most ``num_features`` rows, so its size is known: it is
    broadcast up to ``BROADCAST_BYTES``; beyond, both sides are dealt on the bucket
    and a salt, as a common bucket is in most documents.
    """
    if row_bytes * num_features <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), "bucket", "left")
    salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("__salt", F.pmod(F.hash(id_col), F.lit(SALTS)))
            .join(salted, ["bucket", "__salt"], "left").drop("__salt"))


@dataclass(frozen=True)
class SparseNaiveBayes:
    """``table``: ``(bucket, logs array<double>)`` in class order, for the buckets of the
    training set; any other bucket has ``unseen``. ``labels`` and ``priors`` per class."""

    table: DataFrame
    labels: list[float]
    priors: list[float]
    unseen: list[float]
    num_features: int

    def score(self, rows: DataFrame, docs: DataFrame, id_col: str, weight: str = "weight") -> DataFrame:
        """``(id_col, prediction, scores array<double>)`` for every row of ``docs``.

        A document's score per class is the class prior plus the sum of weight times
        log conditional over its buckets; without buckets it is the prior. The first
        class with the highest score is predicted.
        """
        n = len(self.labels)
        both = join_buckets(rows.select(id_col, "bucket", weight), self.table, id_col, 8 * n + 8, self.num_features)
        logs = F.coalesce("logs", F.array(*map(F.lit, self.unseen)))
        sums = both.groupBy(id_col).agg(*[F.sum(F.col(weight) * logs[k]).alias(f"__s{k}") for k in range(n)])
        scores = F.array(*[F.coalesce(F.col(f"__s{k}"), F.lit(0.0)) + self.priors[k] for k in range(n)])
        best = F.array_position("scores", F.array_max("scores")).cast("int") - 1
        return (docs.select(id_col).join(sums, id_col, "left").select(id_col, scores.alias("scores"))
                .select(id_col, F.array(*map(F.lit, self.labels))[best].alias("prediction"), "scores"))


def fit_sparse_naive_bayes(rows: DataFrame, docs: DataFrame, label: str = "label", weight: str = "weight",
                           num_features: int = 1 << 18, smoothing: float = 1.0) -> SparseNaiveBayes:
    """Multinomial naive Bayes from ``(label, bucket, weight)`` rows.

    ``docs`` has one row per training document with its label (for the priors).
    Weights are summed per class and bucket, combined before the shuffle; only one
    row per class reaches the driver.
    """
    sums = cut_lineage(rows.groupBy(label, "bucket").agg(F.sum(weight).alias("w")))
    total = {r[0]: r[1] for r in sums.groupBy(label).agg(F.sum("w")).collect()}
    count = {r[0]: r[1] for r in docs.groupBy(label).agg(F.count(F.lit(1))).collect()}
    labels = sorted(count)
    norm = [log(total.get(c, 0.0) + num_features * smoothing) for c in labels]
    priors = [log(count[c] + smoothing) - log(sum(count.values()) + len(labels) * smoothing) for c in labels]
    per_class = [F.log(F.coalesce(F.sum(F.when(F.col(label) == c, F.col("w"))), F.lit(0.0)) + smoothing) - norm[k]
                 for k, c in enumerate(labels)]
    table = sums.groupBy("bucket").agg(F.array(*per_class).alias("logs"))
    return SparseNaiveBayes(cut_lineage(table), labels, priors, [log(smoothing) - x for x in norm], num_features)
