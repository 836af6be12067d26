"""Session settings the jobs rely on; a cluster's own settings win where they exist."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# What a stream's state needs wherever its session comes from. Changes are uploaded instead of whole
# files, and rows are not counted, which costs a read before each write.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

# Skew join and coalescing are what keep a hot join key from becoming one long task.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    **STATE,
    # A query over several inputs waits for the slowest one.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # The Python state worker talks over a socket file, not a TCP port.
    "spark.python.unix.domain.socket.enabled": "true",
    # Recording a call site per column call more than doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """Return a session; `master` is given only for local runs, spark-submit sets it elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**COMMON, **conf}.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's setting, or a fresh local one in tests."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="rillhouse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
