"""Column profiles (D10-D12) and centring/scaling.

Each profile is ONE aggregation pass over all requested columns (partial
aggregates per task, one small shuffle), instead of one job per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def summary_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, one row per column.

    Mean and deviation are numbers, null for columns that are not numeric. Min
    and max are taken in the column's own type (text by its order, large
    integers exactly) and shown as text, as columns differ in type.
    """
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        aggs += [F.count(c).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(c).cast("string").alias(f"lo{i}"),
                 F.max(c).cast("string").alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                     F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                     F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def mean_std(df: DataFrame, cols: list[str]) -> DataFrame:
    """The mean and sample-stddev vectors as one row (``mean_<c>``, ``std_<c>``)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}")]
    return df.agg(*aggs)


def safe_corr(a, b):
    """Pearson correlation over the rows where both columns are set; NaN (not an
    error) for a constant column or fewer than two such rows."""
    a, b = F.col(a).cast("double"), F.col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    r = F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
    return F.coalesce(r, F.lit(float("nan")))


def corr_with_target(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """Correlation of every column with ``target``, one row per column."""
    wide = df.agg(*[safe_corr(target, c).alias(f"r{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("corr"))
            for i, c in enumerate(cols)]
    return wide.select(F.inline(F.array(*rows)))


def fit_center_scale(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Fit step of G9: one aggregation; 2 numbers per column reach the driver."""
    row = mean_std(df, cols).first()
    return {c: (row[f"mean_{c}"], row[f"std_{c}"]) for c in cols}


def center_scale(df: DataFrame, cols: list[str],
                 stats: dict[str, tuple[float, float]] | None = None,
                 keep: list[str] | None = None, suffix: str = "") -> DataFrame:
    """``(x - mean) / stddev`` per column.

    The fitted means and deviations are literals in the projection (the
    broadcast value of L5 without a broadcast), so the transform is a narrow,
    code-generated map with no join and no shuffle.
    """
    stats = stats or fit_center_scale(df, cols)
    scaled = [((F.col(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1]))
              .alias(c + suffix) for c in cols]
    return df.select(*(keep or []), *scaled)
