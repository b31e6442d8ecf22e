"""Session settings and shared storage used by the jobs."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Stream state may outgrow the memory of an executor.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    # Telemetry times are UTC; every NTZ <-> timestamp cast relies on this.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
}


def build_session(app: str = "fleetwatt", master: str | None = None, **settings: str) -> SparkSession:
    """Start a session with the fleet settings; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(shuffled_bytes: int, partition_bytes: int = 128 << 20, at_least: int = 200) -> int:
    """Shuffle width that keeps one partition near ``partition_bytes``.

    Adaptive execution merges small partitions but cannot add any, so a job
    over a large history sets its initial width from the input size.
    """
    return max(at_least, -(-shuffled_bytes // partition_bytes))


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the results depend on, on a session started elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


@functools.cache
def local_folder() -> str:
    """One temporary folder per process, removed at its end."""
    folder = tempfile.mkdtemp(prefix="fleetwatt-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session may go without that setting: all its tasks run on
    this machine, so a temporary folder is visible to each of them.
    """
    conf = spark.sparkContext.getConf()
    base = conf.get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        base = local_folder()
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
