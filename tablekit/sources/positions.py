"""Positions of lines in text files that are read in splits.

A text scan gives lines without their place. Here a line's place follows from its
file, the start of the block it was read from and its order within that block:
one pass counts the lines per block, the counts before each block are added up
over files and blocks (a table with a row per block, not per line), and a second
pass adds them. Lines are never sorted and no task sees more than its splits.

Files are in the order of their paths. A large file may be a folder of part files,
as Spark writes it: line numbers then go on from part to part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def _scan(spark: SparkSession, path: str | list[str], files: list[str] | None) -> DataFrame:
    """Lines with their file, block and a number that ascends within a task.

    Both passes use the same relation, so they are cut into the same splits.
    """
    lines = spark.read.text(path)
    if files is not None:
        lines = lines.where(F.col("_metadata.file_path").isin(files))  # prunes the listing
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("at"), "value")


def _blocks(scan: DataFrame, parts: bool = False) -> DataFrame:
    """``(file, start, first, lines, in_file, in_all)`` per block: the smallest number of its
    lines, their count, and the lines before it in the file (with ``parts``, in the file's
    folder) and in all files."""
    out = scratch_path(scan.sparkSession, "blocks")
    (scan.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"))
         .write.parquet(out))
    blocks = scan.sparkSession.read.parquet(out)
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    in_part = F.coalesce(F.sum("lines").over(before.partitionBy("file").orderBy("start")), F.lit(0))
    folder = F.regexp_replace("file", "[^/]*$", "")
    in_folder = F.coalesce(F.sum("lines").over(before.partitionBy(folder).orderBy("file")), F.lit(0))
    files = blocks.groupBy("file").agg(F.sum("lines").alias("lines"))
    files = files.select("file", F.coalesce(F.sum("lines").over(before.orderBy("file")), F.lit(0)).alias("before"),
                         (in_folder if parts else F.lit(0)).alias("parts_before"))
    out = scratch_path(scan.sparkSession, "blocks")
    (blocks.withColumn("in_part", in_part).join(files, "file")
           .select("file", "start", "first", "lines", (F.col("in_part") + F.col("parts_before")).alias("in_file"),
                   (F.col("in_part") + F.col("before")).alias("in_all")).write.parquet(out))
    return scan.sparkSession.read.parquet(out)  # its size is known: broadcast while small


def _numbered(scan: DataFrame, blocks: DataFrame) -> DataFrame:
    order = F.col("at") - F.col("first") + 1
    return (scan.join(blocks, ["file", "start"])
            .select("file", (F.col("in_file") + order).alias("line_no"),
                    (F.col("in_all") + order).alias("position"), "value"))


def positioned_lines(spark: SparkSession, path: str | list[str], parts: bool = False) -> DataFrame:
    """``(file, line_no, position, value)``: places from 1, in the file and over all files.

    With ``parts`` the files of a folder are parts of one, in the order of their
    paths: ``line_no`` counts the lines of the folder.
    """
    scan = _scan(spark, path, None)
    return _numbered(scan, _blocks(scan, parts))


def first_lines_of_files(spark: SparkSession, path: str | list[str], n: int, strict: bool = True) -> DataFrame:
    """The first ``n`` lines over all files, ``(position, value)``.

    Only files that hold one of them are read again. Fewer than ``n`` lines raise,
    as indexing past the end does; with ``strict=False`` all lines are given.
    """
    blocks = _blocks(_scan(spark, path, None))
    found = blocks.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    if strict and found < n:
        raise IndexError(f"{found} lines, {n} wanted")
    # At most n files: each has a line.
    files = [r[0] for r in blocks.where(F.col("in_all") < n).select("file").distinct().collect()]
    scan = _scan(spark, path, files)
    return _numbered(scan, _blocks(scan)).where(F.col("position") <= n).select("position", "value")


def first_line_of_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A3: the first line over all files as a one-row frame ``(value)``; empty without lines."""
    return first_lines_of_files(spark, path, 1, strict=False).select("value")
