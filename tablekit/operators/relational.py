"""Relational operators: grouped counts and sums, distinct sets, joins, splits, sorts.

Every aggregate here is a built-in aggregate, so Spark plans a partial
(map-side) aggregate before the shuffle and a final one after it: a key that
holds a third of all rows costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.parse import parse_long_or_zero
from ..functions.text import TOKENIZER_DELIMITERS, join_sorted


def word_count(df: DataFrame, text_col: str = "value", tokens: Column | None = None,
               out: str = "word", count: str = "n") -> DataFrame:
    """Tokens of every line, counted (default tokeniser: StringTokenizer set).

    The default splits on the delimiter set and drops empty pieces after the
    explode (a plain filter, kept in generated code) rather than filtering the
    array with a lambda.
    """
    if tokens is None:
        words = (df.select(F.explode(F.split(F.col(text_col), TOKENIZER_DELIMITERS, -1))
                           .alias(out)).where(F.col(out) != ""))
    else:
        words = df.select(F.explode(tokens).alias(out))
    return words.groupBy(out).agg(F.count(F.lit(1)).alias(count))


def count_by_key(df: DataFrame, *keys: str, count: str = "n") -> DataFrame:
    """Rows per key (one or more key columns)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count))


def sum_by_key(df: DataFrame, key: str, value: Column | str, out: str = "total") -> DataFrame:
    """Sum per key."""
    v = F.col(value) if isinstance(value, str) else value
    return df.groupBy(key).agg(F.sum(v).alias(out))


def sum_by_key_or_zero(df: DataFrame, key: str, text: Column | str,
                       out: str = "total") -> DataFrame:
    """D3: sum of parsed integers per key; unparsable text counts as 0.

    The key is emitted for every row, so a group whose values are all bad
    still appears, with 0. The sum is a 64-bit sum (ANSI: overflow raises).
    """
    return df.groupBy(key).agg(F.sum(parse_long_or_zero(text)).alias(out))


def distinct_values(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """D4 as rows: the distinct non-null values of ``col``, sorted. Partial
    distinct before the shuffle, then a range-partitioned sort: any number of
    values, written by as many tasks."""
    name = out or col
    return df.select(F.col(col).alias(name)).where(F.col(name).isNotNull()).distinct().orderBy(name)


def distinct_set_line(df: DataFrame, col: str, sep: str = ",", out: str = "values") -> DataFrame:
    """The distinct values of ``col`` as one sorted, joined string.

    ``distinct`` runs first as a parallel shuffle on the value, so the final
    aggregate sees each value once. Its result is one string by definition,
    made lazily by one task; ``distinct_values`` gives the same values as rows.
    """
    vals = df.select(F.col(col).alias("v")).where(F.col("v").isNotNull()).distinct()
    return vals.agg(join_sorted(F.collect_list("v"), sep).alias(out))


def global_count(df: DataFrame, out: str = "n") -> DataFrame:
    """Number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(out))


def filtered_sum(df: DataFrame, cond: Column, value: str, out: str = "total") -> DataFrame:
    """Global sum over the rows that pass ``cond`` (pushed to the scan)."""
    return df.where(cond).agg(F.sum(value).alias(out))


def join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Equi-join; Spark broadcasts a side only when its planned size is
    under ``spark.sql.autoBroadcastJoinThreshold``, else sort-merge, and AQE
    re-plans from runtime sizes and splits skewed partitions."""
    return left.join(right, on, how)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    """distinct rows of a projection (partial distinct before shuffle)."""
    return df.select(*cols).distinct()


HASH_BUCKETS = 10000


def hash_bucket(*keys: str) -> Column:
    """A stable bucket 0..9999 from the md5 of the key text.

    Independent of partitioning and task order, and the same in any engine
    with md5 (first 8 hex digits as an integer, modulo 10000).
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"),
                  F.lit(HASH_BUCKETS))


def split_label(df: DataFrame, keys: list[str], weights: list[float],
                out: str = "part") -> DataFrame:
    """F3 (stable form): label each row with the index of its part."""
    total = float(sum(weights))
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(int(round(acc * HASH_BUCKETS)))
    b = hash_bucket(*keys)
    label = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        label = F.when(b < bounds[i], F.lit(i)).otherwise(label)
    return df.withColumn(out, label.cast("int"))


def hash_split(df: DataFrame, keys: list[str], weights: list[float]) -> list[DataFrame]:
    """F3 (stable form): disjoint parts by key hash, in proportion to ``weights``."""
    labelled = split_label(df, keys, weights, "__part")
    return [labelled.where(F.col("__part") == i).drop("__part") for i in range(len(weights))]


def random_split(df: DataFrame, weights: list[float], seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` with a fixed seed (disjoint, covering parts)."""
    return df.randomSplit(weights, seed)


def sort_by(df: DataFrame, *cols) -> DataFrame:
    """Global sort (sampled range partitioning, then per-partition sort)."""
    return df.orderBy(*cols)


def order_report(df: DataFrame, key: str) -> DataFrame:
    """E1/E2 evidence: rows, partitions that hold rows, and inversions of ``key`` in
    the order in which ``df`` delivers its rows, within and between partitions.

    Each partition keeps its extremes and its inversions, so only one row per
    partition is compared across partitions.
    """
    key_type = df.schema[key].dataType.simpleString()

    def runs(batches):
        import pandas as pd
        first = last = None
        rows = inversions = 0
        for pdf in batches:
            keys = pdf[key]
            if not len(keys):
                continue
            inversions += int((keys.to_numpy()[1:] < keys.to_numpy()[:-1]).sum())
            inversions += int(last is not None and keys.iloc[0] < last)
            first = keys.iloc[0] if first is None else first
            last, rows = keys.iloc[-1], rows + len(keys)
        if rows:
            yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "first": [first], "last": [last],
                                "n": [rows], "inner": [inversions]})
    parts = df.select(key).mapInPandas(runs, f"part int, first {key_type}, last {key_type}, n bigint, inner bigint")
    before = F.lag("last").over(Window.orderBy("part"))
    parts = parts.withColumn("outer", (F.col("first") < before).cast("bigint"))
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                     F.coalesce(F.sum("inner"), F.lit(0)).alias("inversions_within"),
                     F.coalesce(F.sum("outer"), F.lit(0)).alias("inversions_between"))


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """First ``n`` rows by an order (a top-n per task, then a merge)."""
    return df.orderBy(*order).limit(n)
