"""Vector columns."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Dense feature vector from numeric columns (JVM-side transformer)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


def array_as_vector(df: DataFrame, col: str, out: str = "features") -> DataFrame:
    """An ``array<float|double>`` column as an ML vector."""
    return df.withColumn(out, array_to_vector(F.col(col)))


def unpack(df: DataFrame, col: str, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """Vector elements to named double columns."""
    arr = vector_to_array(F.col(col))
    return df.select(*(keep or []), *[arr.getItem(i).alias(n) for i, n in enumerate(names)])
