"""Token-id files: documents tokenised, range-coded, written and read back.

A file set is a Parquet folder of frames; Spark's writer commits it, so a lost
task is written again and readers need no local folder. A frame holds whole
documents, about ``FRAME`` ids: their ids and sizes, and the ids as separately
decodable, checksummed blocks (see ``idcoder``). Frames are in ascending
document order: ``shard`` is the range partition, ``seq`` the frame in it and
``start`` the ids of the shard before it.

Defined results: a null text is empty, an empty document is its end id alone.
Every input row is a document, also repeated ones; rows with a null id come
first. Other columns are ignored. An empty table gives an empty file set.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import idcoder
from .base import arrow_map, bounded_batches, slices
from .tokens import encoder

#: Ids after which a frame is closed; a longer document is a frame of its own.
FRAME = idcoder.LANES * idcoder.LONGEST
SCHEMA = "shard int, seq int, start long, n_ids long, doc_ids array<long>, sizes array<long>, coded binary"


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Tokenise, append ``end_id`` to each document, and write in ascending id order."""
    docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("bigint").alias("id"))
    docs = docs.repartitionByRange("id").sortWithinPartitions("id")
    bounded_batches(docs)

    def run(batches):
        coder, shard = encoder(tokenizer), TaskContext.get().partitionId()
        ids, names, sizes, held, start, seq = [], [], [], 0, 0, 0

        def frame():
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([start]), pa.array([held]),
                 pa.array([names], pa.list_(pa.int64())), pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                 pa.array([idcoder.encode(np.concatenate(ids))], pa.binary())],
                ["shard", "seq", "start", "n_ids", "doc_ids", "sizes", "coded"])
        for rows in batches:
            for part in slices(rows.column(0)):
                got, first = coder.encode(part)
                ids.append(np.insert(got, first[1:], end_id).astype(np.uint32))
                sizes.append(np.diff(first) + 1)
                names += rows.column(1)[part.rows].to_pylist()
                held += len(ids[-1])
                if held >= FRAME:
                    yield frame()
                    ids, names, sizes, held, start, seq = [], [], [], 0, start + held, seq + 1
        if held:
            yield frame()
    docs.mapInArrow(run, SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, n_tokens, ids)``; ``ids`` are little-endian unsigned 32-bit
    integers, ``start`` counts the ids of all documents before."""
    frames = spark.read.schema(SCHEMA).parquet(path)
    # One row per shard, that is per range partition of the writer: a window over
    # these rows gives the ids before each shard, without reading any coded bytes.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = (frames.groupBy("shard").agg(F.sum("n_ids").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))

    def make():
        def batch(rows: pa.RecordBatch):
            for i in range(rows.num_rows):
                ids = idcoder.decode(rows.column(4)[i].as_buffer().to_pybytes())
                size = np.array(rows.column(3)[i].as_py(), np.int64)
                end = np.cumsum(size)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows.column(0)[i].as_py()] * len(size), pa.int32()),
                     pa.array(rows.column(2)[i].as_py(), pa.int64()), pa.array(end - size + rows.column(1)[i].as_py()),
                     pa.array(size), pa.array([raw[4 * (e - s):4 * e] for s, e in zip(size, end)], pa.binary())],
                    ["shard", "id", "at", "n_tokens", "ids"])
        return batch
    docs = arrow_map(frames.select("shard", "start", "doc_ids", "sizes", "coded"), make,
                     "shard int, id long, at long, n_tokens long, ids binary")
    return (docs.join(F.broadcast(shards), "shard")  # as many rows as the writer had tasks
            .select(F.col("id").alias(id_col), (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids"))
