"""JSON source (A8) and schema listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str | list[str],
              schema: StructType | str | None = None) -> DataFrame:
    """JSON lines; inferred schema when none is given (one extra scan)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema tree as a table ``(column, type, nullable)``.

    Built from ``df.schema`` only: no data is read.
    """
    from .literal import literal_table
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return literal_table(spark, rows, "column string, type string, nullable boolean")
