"""Session defaults and the shared folder for state that must survive executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Day and hour buckets follow the session zone, so every job pins it.
ZONE = "UTC"


def build_session(app: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` wins over them."""
    settings = {
        "spark.sql.session.timeZone": ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed lookup is split even when that costs one more exchange downstream.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Checkpointed frames leave the shared folder once nothing refers to them.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_zone(spark: SparkSession) -> None:
    """Set the zone on a session made elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone") != ZONE:
        spark.conf.set("spark.sql.session.timeZone", ZONE)


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints and written tables, on storage every executor can reach."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = getattr(shared_dir, "_local_root", None)
    if root is None:
        root = shared_dir._local_root = tempfile.mkdtemp(prefix="kerbside-")
    return root


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A folder name under the shared root that no earlier run has used."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable; keeps a folder that is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
