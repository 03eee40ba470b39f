"""Typed parquet tables of a test-data folder."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table; Catalyst prunes columns and pushes filters into the scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(scan: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Give CPU-heavy work over a bare scan at least ``partitions`` tasks.

    For scans only: the listing tells, without a job, how many files there are and
    how many splits their bytes make. A table of at least that many of either (any
    large table, also one in a few large files) is read as it is, without a
    shuffle. Less is hash-spread on ``keys`` (unique, so no partition is hot;
    deterministic on retry). Default: the cluster's parallelism.
    """
    partitions = partitions or scan.sparkSession.sparkContext.defaultParallelism
    if len(scan.inputFiles()) >= partitions or scan_bytes(scan) // split_bytes(scan.sparkSession) >= partitions:
        return scan
    return scan.repartition(partitions, *keys)


def spread_rows(scan: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """As ``spread``, for work that keeps its rows: also enough tasks for about
    ``rows`` rows each. The rows are counted, which reads the files' footers."""
    parallelism = scan.sparkSession.sparkContext.defaultParallelism
    return spread(scan, keys, max(parallelism, -(-scan.count() // rows)))


def scan_bytes(scan: DataFrame) -> int:
    """Bytes of a bare scan's files, as the plan's statistics have them."""
    return int(str(scan._jdf.queryExecution().analyzed().stats().sizeInBytes()))


def split_bytes(spark: SparkSession) -> int:
    """Bytes of a scan split in this session."""
    size = spark.conf.get("spark.sql.files.maxPartitionBytes").lower()
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """A14 for every table: temp views named after the tables."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
