"""Session construction and shared storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_STORES = "org.apache.spark.sql.execution.streaming.state."

# Settings every feedlake job relies on. Instants are TIMESTAMP with the session
# zone pinned to UTC; local days are derived explicitly with a named zone.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    STATE_STORE: f"{STATE_STORES}RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "feedlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
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
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Operators assume the session zone is UTC (instants render as UTC wall clock)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_keyed_state(spark: SparkSession) -> None:
    """``transformWithState`` keeps several column families, which Spark's default state store lacks:
    streams that the session starts from here on keep their state in RocksDB. A store that was
    chosen is left, and a restarted query keeps the one that its checkpoint names."""
    if spark.conf.get(STATE_STORE) == f"{STATE_STORES}HDFSBackedStateStoreProvider":
        spark.conf.set(STATE_STORE, BASE_CONF[STATE_STORE])


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    On a cluster ``spark.checkpoint.dir`` names shared storage reachable by every
    executor. Only a local session (tests) may go without: it gets a temporary
    folder, registered as the checkpoint dir; any other session is refused.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session has no context: use its conf
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None) if sc is None else \
        sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if sc is None or not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedlake-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
