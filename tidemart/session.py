"""Session settings and scratch storage shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package is written for. None of them is a size: partition
# counts and memory belong to the cluster's own configuration.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs a shuffle for the aggregation behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}

STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # State lives on disk and in the checkpoint, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Progress entries that are kept; ``dropped_rows`` needs those of a whole run.
    "spark.sql.streaming.numRecentProgressUpdates": "100000",
    # Merge a hot user's rows before the shuffle of a session-window aggregation.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Keeps the folders of local runs alive until the process ends, then deletes them.
_local_scratch: list[tempfile.TemporaryDirectory] = []


def build_session(app_name: str = "tidemart", master: str | None = None, **conf) -> SparkSession:
    """Create (or reuse) a session with the settings above; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Day boundaries are UTC days, whatever zone the cluster runs in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def stream_session(spark: SparkSession) -> SparkSession:
    """A sibling session with streaming settings, so that the caller's stay as they are.

    The number of state partitions is ``spark.sql.shuffle.partitions`` as it is set, and fixed
    for the life of a checkpoint: it must not depend on the executors that happen to be there
    when a stream starts.
    """
    session = spark.newSession()
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    return session


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Local runs without that setting get a temporary folder. On a cluster there is no
    fallback: a machine-local folder would be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        holder = tempfile.TemporaryDirectory(prefix="tidemart-", ignore_cleanup_errors=True)
        _local_scratch.append(holder)
        base = holder.name
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
