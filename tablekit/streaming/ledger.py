"""What each micro-batch did, as rows.

Spark reports every trigger's start, rows and duration; here these reports become
a table beside the batches' output, so that the interval and the bounded run of a
stream can be checked from data.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.literal import literal_table

LEDGER = "batch_id bigint, started timestamp, rows bigint, seconds double"


class BatchLedger(StreamingQueryListener):
    """Collects one row per batch that had input, of the queries with ``name``.

    Rows are per batch, not per record; a long-running stream flushes them with
    ``flush`` into a folder, where a replayed batch replaces its row.
    """

    def __init__(self, name: str):
        self.name, self.rows = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.name and p.numInputRows > 0:
            self.rows[p.batchId] = (p.batchId, p.timestamp, p.numInputRows, p.durationMs["triggerExecution"] / 1000.0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        rows = literal_table(spark, sorted(self.rows.values()), LEDGER.replace("timestamp", "string"))
        return rows.withColumn("started", F.col("started").cast("timestamp"))

    def flush(self, spark: SparkSession, folder: str) -> None:
        """Write the rows held, one folder per batch, and forget them."""
        held = sorted(self.rows)
        (self.table(spark).withColumn("batch", F.col("batch_id"))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder))
        for batch_id in held:
            del self.rows[batch_id]


def per_batch_rows(lines: DataFrame, make: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str,
                   name: str, processing_time: str) -> StreamingQuery:
    """Start a stream that writes ``make(batch)`` with its ``batch_id``; a replayed batch
    replaces its own output."""
    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint")) \
            .write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return (lines.writeStream.queryName(name).foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(processingTime=processing_time).start())


def run_bounded(query: StreamingQuery, seconds: float, until: Callable[[], bool] | None = None) -> float:
    """K3: let a query run for at most ``seconds`` (less, once ``until`` holds), then stop
    it; returns the seconds it ran."""
    began = time.monotonic()
    try:
        while time.monotonic() - began < seconds and not (until and until()):
            if query.awaitTermination(min(0.2, seconds)):
                break
    finally:
        query.stop()
    return time.monotonic() - began


def interval_report(ledger: DataFrame, interval: float, late: float = 1.0) -> DataFrame:
    """K2: per batch, whether it began when the interval says: at the first multiple of
    ``interval`` after the batch before it began, or when that ended, if it took longer
    (at most ``late`` seconds later). The first batch is on time."""
    start = F.unix_micros("started") / 1e6
    order = Window.orderBy("batch_id")
    before = F.lag(start).over(order)
    ended = before + F.lag("seconds").over(order)
    due = F.greatest(F.floor(before / interval) * interval + interval, ended)
    return ledger.select("batch_id", "rows", F.coalesce(
        (start - due).between(-0.05, late), F.lit(True)).alias("on_time"))
