"""User-code surface (L1-L5) on Arrow batches.

Built-in expressions are always preferred; these wrappers are for logic the
expressions cannot state. All of them move whole Arrow batches to Python
(``pandas_udf`` / ``mapInPandas``), never one row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DataType


def scalar_udf(fn: Callable[[pd.Series], pd.Series], return_type: DataType | str):
    """L1: a vectorised row function (Series in, Series out)."""
    return pandas_udf(fn, returnType=return_type)


def predicate_udf(fn: Callable[[pd.Series], pd.Series]):
    """L2: a vectorised row predicate (Series in, bool Series out)."""
    return pandas_udf(fn, returnType="boolean")


def flat_map(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
             schema: str) -> DataFrame:
    """L3: one-to-many function over batches (a UDTF): each batch in, any rows out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield fn(pdf)
    return df.mapInPandas(run, schema)


def fold_by_key(df: DataFrame, key: str, value: str, fold: Callable[[pd.Series], object],
                out: str = "value", merge: Callable[[pd.Series], object] | None = None,
                result_type: str = "double") -> DataFrame:
    """L4: a user fold per key with a map-side combine.

    Phase 1 (``mapInPandas``) folds each partition's rows per key; phase 2
    (grouped-aggregate ``pandas_udf``) folds the partials. A group in phase 2
    holds at most one partial per input partition, so a key that owns a third
    of all rows never sends its rows to one task. ``fold`` must be
    associative (e.g. sum, min, max, a joined set); ``merge`` defaults to
    ``fold``. ``result_type`` is the type of partials and results: ``double``,
    ``bigint`` (exact), ``string`` and other types of one value.
    """
    merge = merge or fold
    key_type = df.schema[key].dataType.simpleString()

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One running partial per key of this partition: memory is bounded by
        # the partition's distinct keys, not by its rows or batches.
        acc: pd.Series | None = None
        for pdf in batches:
            part = pdf.groupby(key, dropna=False, sort=False)[value].agg(fold)
            acc = part if acc is None else (
                pd.concat([acc, part]).groupby(level=0, dropna=False, sort=False).agg(merge))
        if acc is not None and len(acc):
            yield pd.DataFrame({name: pd.Series([None if pd.isna(x) else x for x in values], dtype=object)
                                for name, values in ((key, acc.index), ("__partial", acc))})

    partials = df.select(key, value).mapInPandas(partial, f"`{key}` {key_type}, __partial {result_type}")

    @pandas_udf(result_type)
    def merged(v: pd.Series) -> Any:
        return merge(v)

    return partials.groupBy(key).agg(merged(F.col("__partial")).alias(out))


def shared_value(value) -> Column:
    """A read-only value shared by all tasks: a literal in the plan."""
    return F.lit(value)
