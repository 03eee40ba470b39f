"""Shared helpers: scratch tables, label folds, batches of texts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that one numpy pass handles (a longer single text is a pass of its own).
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch, and Spark's own default as it reports it.
BATCH_BYTES, DEFAULT_BATCH = "8m", "67108864b"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and continue from the copy."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids hash as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % modulus


def fixed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows (all, if there are fewer), the same ones in every run.

    Rows are taken by a hash of ``key``; the share follows from one count.
    """
    total = df.count()
    if total <= rows:
        return df
    share = int(rows / total * (1 << 30))
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < share)


def bounded_batches(df: DataFrame) -> None:
    """Lower Spark's default size of an Arrow batch (64 MB) to ``BATCH_BYTES``."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) == DEFAULT_BATCH:
        conf.set(key, BATCH_BYTES)


def arrow_map(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with a state per task: ``make()`` gives the batch function.

    Batches of whole texts are kept at ``BATCH_BYTES`` for this session, unless it
    sets a size of its own: they exist in the JVM and in Python at once.
    """
    bounded_batches(df)
    def run(batches):
        fn = make()
        for batch in batches:
            yield from fn(batch)
    return df.mapInArrow(run, schema)


class Texts:
    """Consecutive texts as one byte array: text i is ``data[offs[i]:offs[i+1]]``.

    ``rows`` is their slice of the batch; null texts are empty.
    """

    __slots__ = ("data", "offs", "rows")

    def __init__(self, data: np.ndarray, offs: np.ndarray, rows: slice):
        self.data, self.offs, self.rows = data, offs, rows

    def __len__(self) -> int:
        return len(self.offs) - 1


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a string or binary column; nulls get length 0."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)), offs


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of about ``limit`` bytes; no text is cut."""
    if len(column) == 0:
        return
    data, offs = buffers(column)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1
        to = min(n, max(to, at + 1))
        yield Texts(data[offs[at]:offs[to]], offs[at:to + 1] - offs[at], slice(at, to))
        at = to


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id in an edge list; component = smallest id.

    Min-label propagation with pointer jumping; each round is written to the
    shared scratch folder, so a lost executor costs at most one round, and
    nothing but the number of changed rows reaches the driver. Aggregations
    combine before the shuffle and joins may be split when skewed, so a hub of
    many edges is no hot task.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = materialize(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
                       .distinct(), "edges")
    labels = materialize(both.groupBy(F.col("u").alias("id"))
                         .agg(F.min("v").alias("v"))
                         .select("id", F.least("id", "v").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("id", "v"), "v")
                .groupBy(F.col("u").alias("id")).agg(F.min("component").alias("near")))
        hop = (labels.join(near, "id")
               .select("id", F.col("component").alias("old"),
                       F.least("component", "near").alias("hop")))
        root = labels.select(F.col("id").alias("hop"), F.col("component").alias("root"))
        step = materialize(hop.join(root, "hop", "left")
                           .select("id", "old", F.least("hop", "root").alias("component")), "labels")
        labels = step.select("id", "component")
        if step.where("old <> component").isEmpty():
            return labels
