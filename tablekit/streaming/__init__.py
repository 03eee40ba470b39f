"""Micro-batch streams (A13, A18, K1-K4) on Structured Streaming.

Counts are per batch, not running (the DStream job reduces each batch on its
own), so the aggregation runs inside ``foreachBatch`` on the static batch
frame: no state store, no watermark. Each batch is written to its own
``batch_id=<n>`` folder with overwrite, so a batch replayed after a failure
replaces its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import space_tokens
from ..operators.relational import word_count

# Fixed values of the stream job: socket port, batch interval, rows printed
# per batch, bounded run time in seconds.
SOCKET_PORT = 7070
BATCH_INTERVAL = "10 seconds"
FIRST_ROWS = 10
RUN_SECONDS = 100

#: Bytes of files that one micro-batch takes.
BATCH_BYTES = 64 << 20


def socket_lines(spark: SparkSession, host: str = "localhost",
                 port: int = SOCKET_PORT) -> DataFrame:
    """Line stream from a TCP socket (connects only when started)."""
    return (spark.readStream.format("socket").option("host", host)
            .option("port", port).load())


def file_lines(spark: SparkSession, folder: str, max_bytes_per_trigger: int = BATCH_BYTES) -> DataFrame:
    """K4: text files arriving in a folder, as a line stream. A batch takes files
    up to a number of bytes, so the number of batches follows the data's size,
    not the number of files."""
    return (spark.readStream.format("text")
            .option("maxBytesPerTrigger", max_bytes_per_trigger).load(folder))


def replay_as_files(lines: DataFrame, folder: str, col: str = "value") -> None:
    """K4: write lines as text files to feed a file stream, one per partition."""
    lines.select(F.col(col).alias("value")).write.mode("overwrite").text(folder)


def batch_word_count(batch: DataFrame, col: str = "value") -> DataFrame:
    """K1: word count of one batch with the stream job's tokeniser."""
    return word_count(batch, tokens=space_tokens(col))


def per_batch_word_count(lines: DataFrame, sink: str, checkpoint: str,
                         processing_time: str | None = BATCH_INTERVAL,
                         available_now: bool = False) -> StreamingQuery:
    """K1/K2: start the per-batch word count; each batch lands in
    ``<sink>/batch_id=<n>`` as parquet."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        (batch_word_count(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}"))

    writer = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def console_first_rows(lines: DataFrame, checkpoint: str, n: int = FIRST_ROWS,
                       processing_time: str = BATCH_INTERVAL) -> StreamingQuery:
    """Print the first ``n`` word counts of every batch (``pprint``)."""
    def show(batch: DataFrame, batch_id: int) -> None:
        batch_word_count(batch).show(n)
    return (lines.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
            .trigger(processingTime=processing_time).start())


def run_for(query: StreamingQuery, seconds: float = RUN_SECONDS) -> None:
    """K3: let a started query run for a bounded time, then stop it."""
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """The per-batch counts written by ``per_batch_word_count``."""
    return spark.read.parquet(sink)
