"""Session settings every job relies on, and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Event times, calendar slots and window bounds are all UTC.
CORRECTNESS_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON field counts with its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Adaptive execution sizes shuffles and splits skewed join partitions.
SQL_SETTINGS = {
    **CORRECTNESS_SETTINGS,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_ROOTS: dict[str, str] = {}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; the cluster supplies ``master`` and memory."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **SQL_SETTINGS,
        # Window state beyond memory, and commits that write changes only.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **(conf or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the correctness settings to a session somebody else created."""
    for key, value in CORRECTNESS_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder for tables and checkpoints, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own machine: on a
    cluster the executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidelake-")
    return _LOCAL_ROOTS[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/tidelake/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it in the shared folder, so that lost executors cost no rerun of what made it."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()
