"""Sinks (A12, A15-A20): key/value text output, table load, previews, caching."""

from __future__ import annotations

import io
from contextlib import contextmanager, redirect_stdout

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_key_value_text(df: DataFrame, path: str, key: str, value: str,
                         sort: bool = True) -> None:
    """``key<TAB>value`` lines, existing output replaced, keys sorted.

    Written with the text writer so keys holding quotes or tabs stay raw, as
    the MapReduce text output writes them (trap 18). Sorting is a range
    partitioning: many sorted part files, not one reducer.
    """
    out = df.orderBy(key) if sort else df
    (out.select(F.concat_ws("\t", F.col(key).cast("string"),
                            F.col(value).cast("string")).alias("value"))
        .write.mode("overwrite").text(path))


def read_key_value_text(spark: SparkSession, path: str, key: str = "key",
                        value: str = "value", value_type: str = "bigint") -> DataFrame:
    """Read a ``key<TAB>value`` folder back; the value is after the last tab."""
    lines = spark.read.text(path)
    return lines.select(
        F.regexp_extract("value", r"(?s)^(.*)\t[^\t]*$", 1).alias(key),
        F.regexp_extract("value", r"(?s)\t([^\t]*)$", 1).cast(value_type).alias(value))


def load_overwrite(df: DataFrame, path: str | None = None, table: str | None = None,
                   fmt: str = "parquet") -> None:
    """Replace a table's content with ``df`` (path-based or catalog table)."""
    writer = df.write.mode("overwrite").format(fmt)
    if table:
        writer.saveAsTable(table)
    elif path:
        writer.save(path)
    else:
        raise ValueError("give a path or a table name")


def insert_overwrite(spark: SparkSession, table: str, query: str) -> None:
    """A12 in SQL: ``INSERT OVERWRITE TABLE t <query>`` replaces the content."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} {query}")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int,
                   path: str | None = None) -> None:
    """Store a table hash-bucketed and sorted on its join key.

    Two tables bucketed the same way on the join key join without a shuffle
    of either side (co-located sort-merge join): the layout is paid once at
    write time instead of at every join. ``path`` makes it an external table
    (e.g. under the shared checkpoint/warehouse folder).
    """
    writer = (df.write.mode("overwrite").format("parquet")
              .bucketBy(buckets, key).sortBy(key))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def preview(df: DataFrame, n: int = 20, truncate: bool | int = True) -> None:
    """Console preview of the first ``n`` rows."""
    df.show(n, truncate=truncate)


def preview_lines(df: DataFrame, n: int = 20, truncate: bool | int = True) -> list[str]:
    """What ``preview`` prints, as lines."""
    out = io.StringIO()
    with redirect_stdout(out):
        preview(df, n, truncate)
    return out.getvalue().rstrip("\n").split("\n")


def take_bounded(df: DataFrame, n: int) -> list:
    """At most ``n`` rows to the driver, never an unbounded collect."""
    return df.limit(n).collect()


def cached(df: DataFrame) -> DataFrame:
    """Keep a reused intermediate; spills to disk rather than recomputing."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` into the session's checkpoint folder (shared storage on a
    cluster) and continue from the written copy: later jobs neither recompute
    its lineage nor lose it with an executor."""
    from ..session import checkpoint_root
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def persisted(df: DataFrame):
    """A20 for a bounded span: the frame is kept while several passes
    (e.g. estimator fits) reuse it, and released afterwards, so no cached
    data outlives the work that needed it."""
    kept = cached(df)
    try:
        yield kept
    finally:
        kept.unpersist()


__all__ = ["write_key_value_text", "read_key_value_text", "load_overwrite",
           "insert_overwrite", "write_bucketed", "preview", "preview_lines",
           "take_bounded", "cached", "persisted", "cut_lineage"]
