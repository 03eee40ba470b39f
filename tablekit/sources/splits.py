"""Scan splits sized to a wanted number of partitions, without a shuffle (A2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def total_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of the files under ``path``: a listing, the files' content is not read."""
    files = spark.read.format("binaryFile").load(path).select("length")
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def split_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session like ``spark`` whose scans are cut into splits of at most ``split_bytes``.

    The split size is a setting of a session, read when a scan runs, so frames that
    need their own size need their own session. Catalog, cached data and executors
    are shared; temporary views are not.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, split_bytes)))
    own.conf.set("spark.sql.files.openCostInBytes", "0")  # files share a partition up to that size
    return own


def read_lines_split(spark: SparkSession, path: str | list[str], min_partitions: int) -> DataFrame:
    """A2: text lines in at least ``min_partitions`` partitions, as ``textFile(path, n)``.

    A partition holds at most the n-th part of all bytes, so there are at least n;
    no line moves between tasks. A line belongs to the partition in which it
    begins: one that is longer than a split leaves the next without lines, and
    compressed files are not cut.
    """
    return split_session(spark, total_bytes(spark, path) // min_partitions).read.text(path)
