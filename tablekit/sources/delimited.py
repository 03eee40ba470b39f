"""Delimited text sources (A5, A6, A7, A11) with declared schemas."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import java_split, remove_char


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType | str,
                   sep: str = ",", header: bool = False, quote: str | None = None,
                   mode: str = "FAILFAST") -> DataFrame:
    """Typed delimited scan with an explicit schema (no inference pass).

    ``quote=None`` keeps quote characters as data (``quote=""``), as a plain
    ``split`` does; ``mode="PERMISSIVE"`` turns short rows and unparsable
    numbers into nulls (trap 19), ``FAILFAST`` raises like ``float(x)`` does.
    """
    reader = (spark.read.schema(schema)
              .option("sep", sep)
              .option("header", str(header).lower())
              .option("mode", mode)
              .option("quote", "" if quote is None else quote))
    return reader.csv(path)


def read_semicolon_quoted(spark: SparkSession, path: str | list[str],
                          schema: StructType | str, header: bool = True) -> DataFrame:
    """``;``-separated, fields in double quotes, quotes dropped."""
    return read_delimited(spark, path, schema, sep=";", header=header, quote='"')


def stripped_fields(lines: DataFrame, fields: list[tuple[str, int, str]], sep: str = ";",
                    char: str = '"', col: str = "value") -> DataFrame:
    """Every ``char`` is removed from a line, which is then split on every
    ``sep``; chosen fields are cast strictly. A separator inside quotes splits
    too, unlike in ``read_semicolon_quoted``."""
    return typed_split(lines.select(remove_char(col, char).alias(col)), sep, fields, col)


def declare_table(ddl: str) -> StructType:
    """A Hive-style column list (``name type, ...``) as a StructType."""
    return StructType.fromDDL(ddl)


def read_declared(spark: SparkSession, path: str | list[str], ddl: str,
                  sep: str = ",") -> DataFrame:
    """A delimited text table of a declared schema, Hive-like.

    Fields are not unquoted and bad or missing fields become null.
    """
    return read_delimited(spark, path, declare_table(ddl), sep=sep, quote=None,
                          mode="PERMISSIVE")


def create_csv_table(spark: SparkSession, name: str, ddl: str, path: str,
                     sep: str = ",") -> DataFrame:
    """A11 in SQL: ``CREATE TABLE ... USING csv`` over a folder, Hive-like
    (fields not unquoted, bad or missing fields null). Returns the table."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING csv OPTIONS (path '{path}', "
              f"sep '{sep}', quote '', mode 'PERMISSIVE')")
    return spark.table(name)


def field(line: Column | str, sep: str, index: int) -> Column:
    """Field ``index`` of ``line`` split on the literal ``sep``.

    Under ANSI mode a missing field raises, as indexing a short Java/Python
    array does.
    """
    line = F.col(line) if isinstance(line, str) else line
    return F.split(line, re.escape(sep), -1).getItem(index)


QUOTED_SEP = '","'


def quoted_fields(lines: DataFrame, picks: dict[str, int], col: str = "value") -> DataFrame:
    """Split lines on the three characters ``","`` and pick fields by index.

    The first field keeps its opening quote and the last its closing one, and
    trailing empty fields are dropped, exactly as Java's string split does; a
    field past the end fails the job (ANSI), as the array index does.
    """
    parts = java_split(F.col(col), QUOTED_SEP)
    return lines.select(*[parts.getItem(i).alias(name) for name, i in picks.items()])


def labelled_messages(lines: DataFrame, positive: str = "ham", truncate_at_comma: bool = False,
                      col: str = "value") -> DataFrame:
    """``kind,message`` lines to ``(label, message)``; ``positive`` -> 0.0,
    anything else 1.0.

    By default only the first comma separates, so a message keeps its own
    commas; ``truncate_at_comma=True`` keeps just the text up to the second
    comma, as ``line.split(",")[1]`` does.
    """
    parts = F.split(F.col(col), ",", -1 if truncate_at_comma else 2)
    kind = parts.getItem(0)
    label = F.when(kind == F.lit(positive), F.lit(0.0)).otherwise(F.lit(1.0))
    return lines.select(label.alias("label"), parts.getItem(1).alias("message"))


def typed_split(lines: DataFrame, sep: str, fields: list[tuple[str, int, str]],
                col: str = "value") -> DataFrame:
    """Split each line and cast chosen fields, e.g. ``[("MPG", 0, "double")]``.

    Casts are strict (ANSI): a malformed number fails the job like ``float()``.
    """
    return lines.select(*[field(col, sep, i).cast(t).alias(name) for name, i, t in fields])
