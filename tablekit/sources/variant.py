"""JSON lines read once: the schema comes from the parsed lines, bad lines stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, StringType, StructField, StructType

from ..session import scratch_path

#: The column that holds a line which is no JSON object.
BAD = "_corrupt_record"


def _as_inferred(t: DataType) -> DataType:
    """A variant's type as schema inference gives it: decimals as doubles, nulls as
    strings, fields in order of their names."""
    if isinstance(t, DecimalType):
        return DoubleType()
    if isinstance(t, ArrayType):
        return ArrayType(_as_inferred(t.elementType))
    if isinstance(t, StructType):
        return StructType([StructField(f.name, _as_inferred(f.dataType)) for f in sorted(t, key=lambda f: f.name)])
    return StringType() if t.simpleString() in ("void", "variant") else t


def parse_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(record variant, bad string)`` per line: parsed once and written to the shared
    scratch folder. A line that is no JSON object is in ``bad``; blank lines are dropped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.try_parse_json("value").alias("v"))
    good = F.col("v").isNotNull() & F.startswith(F.schema_of_variant("v"), F.lit("OBJECT"))
    out = scratch_path(spark, "json_records")
    (parsed.select(F.when(good, F.col("v")).alias("record"), F.when(~F.coalesce(good, F.lit(False)), F.col("value")).alias("bad"))
        .write.parquet(out))
    return spark.read.parquet(out)


def variant_schema(records: DataFrame) -> StructType:
    """The schema that fits all records: an aggregate over them, merged like inference does."""
    found = records.where("record is not null").agg(F.schema_of_variant_agg("record")).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return StructType()
    return _as_inferred(DataType.fromDDL("STRUCT" + found[len("OBJECT"):].replace("OBJECT<", "STRUCT<")))


def read_json_once(spark: SparkSession, path: str | list[str], keep_bad: bool = True) -> DataFrame:
    """JSON lines with the schema found in them, after one scan of the text.

    Columns are ordered by name, as ``spark.read.json`` orders them. With
    ``keep_bad`` a last column ``_corrupt_record`` holds lines that are no object
    (their fields are null); else these lines are left out.
    """
    records = parse_json_lines(spark, path)
    schema = variant_schema(records)
    fields = [F.try_variant_get("record", _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema]
    if keep_bad:
        return records.select(*fields, F.col("bad").alias(BAD))
    return records.where("record is not null").select(*fields)


def _path(name: str) -> str:
    """A field's path; names other than plain ones are quoted."""
    return f'$["{name}"]' if not name.replace("_", "a").isalnum() else f"$.{name}"
