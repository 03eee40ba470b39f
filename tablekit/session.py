"""One session builder and the shared scratch folder.

Every job here builds on the same session settings: adaptive query execution
(runtime coalescing of shuffle partitions, skew-join splitting), UTC session
time zone, Arrow for the few Python batches, and no web UI.

Scratch data (round-tripped text files, stream sinks, loaded tables) lives under
the folder the cluster names in ``spark.checkpoint.dir``; a local folder is only
chosen when that setting is missing, as in tests.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A join side is broadcast only when its planned size is below this bound;
    # above it Spark plans a sort-merge join instead.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "tablekit",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized to an input, for ``get_session(extra=...)``.

    The initial shuffle width gives each reducer about ``target_partition_bytes``
    of input (at least 2 tasks per core); AQE then coalesces partitions towards
    its advisory size and splits skewed ones, so the width only needs to be
    large enough for the biggest shuffle. Scan splits stay at 128 MB.
    """
    width = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` from the session; only a local session (one
    process, as in tests) may leave it unset and gets a local temporary folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "") if sc is None else sc.master
        if not re.match(r"local(\[|$)", master):  # one process, one file system
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tablekit-ckpt-")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder path under the checkpoint root (not created)."""
    root = checkpoint_root(spark)
    return os.path.join(root, "tablekit", *parts, uuid.uuid4().hex)
