"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Set on a session that this package builds itself.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state lives on executor disk, not on the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Build (or reuse) a session; extra settings use ``__`` for dots.

    Leave ``spark.sql.shuffle.partitions`` to the cluster's defaults for batch
    work, where adaptive execution merges small partitions.  For streams choose
    it before the first start: it is frozen into the checkpoint.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times, keys and window bounds are UTC whatever the host zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Unset on a local master, a temporary folder is made and recorded; unset on
    a cluster it is an error, because no machine-local folder would do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="lanewatch-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def working_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared root."""
    return f"{shared_root(spark)}/lanewatch/{label}-{uuid.uuid4().hex}"
