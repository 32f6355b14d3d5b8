"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Recommended when building a session; none of them changes a result.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Arg-max over strings shares an object-hash aggregate with other buffers;
    # the default of 128 groups per task falls back to sorting far too early.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Bytes of one batch to a Python task. Spark's own bound of 64 MiB is held several times over,
# by the JVM and by the worker, for each task of an executor.
ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BATCH_BYTES = 4 << 20

OBSERVER_INTERVAL_SECONDS = 60.0
OBSERVER_INTERVAL_BOUNDS = (5.0, 300.0)


def prepare_session(spark: SparkSession, time_zone: str = "UTC") -> SparkSession:
    """Fix the zone that decides days and weeks, and let tasks find this package.

    Python tasks get this package's functions by value, so executors need no
    installed copy of it. A session without a checkpoint folder gets one, and one that
    leaves Arrow batches at their default size gets smaller ones.
    """
    import leadline

    spark.conf.set("spark.sql.session.timeZone", time_zone)
    if spark.conf.get(ARROW_BATCH).rstrip("b") == str(64 << 20):
        spark.conf.set(ARROW_BATCH, str(ARROW_BATCH_BYTES))
    checkpoint_folder(spark)
    cloudpickle.register_pickle_by_value(leadline)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which every executor sees.

    Where the session names none, a folder below its warehouse is set, which executors
    share as well.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(base)
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def observer_interval(seconds: float = OBSERVER_INTERVAL_SECONDS) -> float:
    low, high = OBSERVER_INTERVAL_BOUNDS
    if not low <= seconds <= high:
        raise ValueError(f"observer interval must lie between {low:g} and {high:g} seconds")
    return float(seconds)
