"""Feature preparation (H1-H6).

Estimators are Spark ML's own: their fit is a distributed aggregation whose
result (label list, IDF vector, principal components) is bounded by the number
of labels or features, not by the number of rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, IDF, PCA, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import lower_tokens
from ..functions.vectors import assemble
from ..sinks import cut_lineage

#: Tasks that share the rows of one term.
SALTS = 8


def string_index(df: DataFrame, col: str, out: str) -> tuple[DataFrame, object]:
    """H1/H2: index by descending frequency, ties alphabetical (Spark's order).

    A numeric column is indexed by its string form, as Spark ML does.
    """
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="frequencyDesc",
                          handleInvalid="error").fit(df)
    return model.transform(df), model


def tokenize(df: DataFrame, col: str, out: str = "words") -> DataFrame:
    """Spark ML ``Tokenizer`` (lower case, split on whitespace)."""
    return Tokenizer(inputCol=col, outputCol=out).transform(df)


def tfidf_stages(text_col: str, out: str = "features",
                 num_features: int = 1 << 18) -> list:
    """H3/H4/H6: Tokenizer -> HashingTF (2^18 buckets) -> IDF stages."""
    tok = Tokenizer(inputCol=text_col, outputCol="__words")
    tf = HashingTF(inputCol="__words", outputCol="__tf", numFeatures=num_features)
    idf = IDF(inputCol="__tf", outputCol=out, minDocFreq=0)
    return [tok, tf, idf]


def fit_pipeline(stages: list, train: DataFrame) -> PipelineModel:
    """H6: fit all stages once; the model applies them to new rows.

    Each estimator stage rescans its input, so the training set is persisted
    (memory and disk) for the duration of the fit.
    """
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(train)
    finally:
        train.unpersist()


def tf_idf_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """H3/H4 as a relational job: ``(id, term, tf, df, idf, tf_idf)``.

    Same tokens as ``Tokenizer`` and the IDF formula of Spark ML,
    ``ln((m + 1) / (df + 1))`` with ``m`` documents. Term counts, a grouped count
    on (doc, term), are written once: both the document frequencies and the
    result read them, so texts are tokenised and shuffled once. The
    document-frequency table has one row per distinct term and is joined on the
    term and a salt (broadcast while small, sort-merge beyond).
    """
    docs = df.select(id_col, text_col).where(F.col(text_col).isNotNull())
    terms = docs.select(id_col, F.explode(lower_tokens(text_col)).alias("term"))
    tf = cut_lineage(terms.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))
    m = docs.agg(F.count(F.lit(1)).alias("m"))
    # A frequent term is in most documents: its rows go to SALTS tasks.
    dfreq = (tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
               .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    # m is a scalar subquery: computed once, substituted as a value.
    idf = dfreq.select("term", "salt", "df",
                       F.log((m.scalar() + 1) / (F.col("df") + 1)).alias("idf"))
    return (tf.withColumn("salt", F.pmod(F.hash(id_col), F.lit(SALTS))).join(idf, ["term", "salt"])
              .select(id_col, "term", "tf", "df", "idf",
                      (F.col("tf") * F.col("idf")).alias("tf_idf")))


def fit_pca(df: DataFrame, features: str, k: int):
    """H5: principal components (covariance by a tree aggregate, SVD of d x d)."""
    return PCA(k=k, inputCol=features, outputCol="__pca").fit(df)


def fit_pca_columns(df: DataFrame, cols: list[str], k: int) -> list[list[float]]:
    """H5 on plain columns: the estimator's top-``k`` components, sign-fixed.

    Nulls fail the fit, as the estimator takes no partial vectors.
    """
    return pca_sign_fixed(fit_pca(assemble(df, cols, out="__v"), "__v", k))


def pca_sign_fixed(model) -> list[list[float]]:
    """Components as columns of a d x k matrix, each with its largest-magnitude
    entry made positive so results are reproducible across solvers."""
    pc = model.pc.toArray()
    d, k = pc.shape
    cols = []
    for j in range(k):
        v = [float(pc[i, j]) for i in range(d)]
        big = max(range(d), key=lambda i: abs(v[i]))
        s = -1.0 if v[big] < 0 else 1.0
        cols.append([s * x for x in v])
    return cols


def pca_project(df: DataFrame, cols: list[str], components: list[list[float]],
                keep: list[str] | None = None, prefix: str = "pc") -> DataFrame:
    """Projection ``x . v_j`` (not centred, as Spark's PCA model) as column
    arithmetic: one narrow, code-generated map."""
    outs = []
    for j, v in enumerate(components):
        expr = sum((F.col(c).cast("double") * F.lit(v[i]) for i, c in enumerate(cols)),
                   F.lit(0.0))
        outs.append(expr.alias(f"{prefix}{j + 1}"))
    return df.select(*(keep or []), *outs)


def pca_transform_array(model, df: DataFrame, out: str = "pca") -> DataFrame:
    """The model's own transform, vector as ``array<double>``."""
    return model.transform(df).withColumn(out, vector_to_array("__pca")).drop("__pca")

