"""Text line sources (A1-A4) and text columns turned into numbered lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .splits import read_lines_split


def read_lines(spark: SparkSession, path: str | list[str],
               min_partitions: int | None = None) -> DataFrame:
    """A1/A2: one row per line, column ``value``.

    ``min_partitions`` mirrors ``textFile(path, n)``: the files are cut into at
    least that many splits (see ``splits``); no line is shuffled.
    """
    return read_lines_split(spark, path, min_partitions) if min_partitions else spark.read.text(path)


def first_value(lines: DataFrame, col: str = "value") -> str | None:
    """A19 bounded fetch: the first line of a scan (one row to the driver)."""
    row = lines.select(col).first()
    return None if row is None else row[0]


def drop_lines_equal(lines: DataFrame, header: str | Column | DataFrame | None = None,
                     col: str = "value") -> DataFrame:
    """A3: drop every line equal to the header (not just the first one).

    ``header`` may be a literal, or a one-row DataFrame holding it in ``col``
    (an anti-join against a single row, so the broadcast side is bounded).
    With no header given, the first line of the scan is used.
    """
    if isinstance(header, DataFrame):
        one = header.select(F.col(col).alias("__header")).limit(1)
        return lines.join(F.broadcast(one), F.col(col) == F.col("__header"), "left_anti")
    if header is None:
        header = first_value(lines, col)
        if header is None:
            return lines
    cond = F.col(col) != (header if isinstance(header, Column) else F.lit(header))
    # A null line is kept, as `x != firstLine` keeps it in Python.
    return lines.where(cond | F.col(col).isNull())


def drop_lines_containing(lines: DataFrame, token: str, col: str = "value") -> DataFrame:
    """Drop every line that contains ``token`` anywhere."""
    return lines.where(~F.col(col).contains(token) | F.col(col).isNull())


def numbered_lines(df: DataFrame, id_col: str, text_col: str,
                   out: str = "value") -> DataFrame:
    """Split a text column into lines with their 1-based position.

    Gives ``(id_col, line_no int, value)``; the position is what a file scan
    does not carry, so first-n and first-line rules can be exact.
    """
    return (df.select(id_col, F.posexplode(F.split(F.col(text_col), "\n", -1)))
              .select(id_col, (F.col("pos") + 1).cast("int").alias("line_no"),
                      F.col("col").alias(out)))


def first_line(lines: DataFrame, order_cols: list[str], col: str = "value") -> DataFrame:
    """The line with the smallest ``order_cols`` as a one-row DataFrame.

    A global ``min_by`` with partial aggregation: every task keeps one candidate,
    so no sort of all lines is needed.
    """
    return lines.agg(F.min_by(F.col(col), F.struct(*order_cols)).alias(col))


def first_n_lines(lines: DataFrame, n: int, order_cols: list[str]) -> DataFrame:
    """The first ``n`` lines by position; fewer lines give all of them.

    ``orderBy(...).limit(n)`` is planned as a top-n (each task keeps n rows).
    """
    return lines.orderBy(*order_cols).limit(n)
