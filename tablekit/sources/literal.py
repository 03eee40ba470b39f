"""Literal rows (A9) and typed, named projections (A10)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def literal_table(spark: SparkSession, rows: Iterable[tuple],
                  schema: StructType | str) -> DataFrame:
    """A small literal table with a declared schema (no inference).

    The rows become literals in the plan (``inline`` of an array of structs
    over a one-row range), so no Python worker takes part and the optimiser
    sees the values; meant for small, known rows (lookup tables, reports).
    """
    rows = list(rows)
    st = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], st)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, st.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def typed(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A10: rename and cast in one projection: ``{"new_name": "src type"}``.

    Each value is ``"<source column> <spark type>"``; casts are strict.
    """
    out = []
    for name, spec in columns.items():
        src, _, typ = spec.partition(" ")
        out.append(F.col(src).cast(typ or "string").alias(name))
    return df.select(*out)
