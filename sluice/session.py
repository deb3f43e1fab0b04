"""Session helpers: building a local session for tests/bench and finding a
shared scratch folder for lineage cuts and materialised intermediates.

On a cluster the scratch root is whatever the cluster names in
``spark.checkpoint.dir``; we only invent a folder when that setting is
unset (local tests), never a machine-local one behind the cluster's back.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins at runtime (size-checked
# broadcast conversion, skew-join splitting, partition coalescing); the session
# zone is pinned to UTC because the reference treats all timestamps as UTC.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "sluice", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a private one only when the
    session has none and runs in one process (tests). On a cluster a folder
    of one machine would not be seen by the others: that is an error."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir is not set; {master} needs a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="sluice-ckpt-")
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for written
    intermediates (landing trees, Bronze snapshots, stream sinks)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sluice-{name}-{uuid.uuid4().hex[:12]}"


def sizing_conf(input_bytes: int, partition_bytes: int = 256 << 20,
                scan_split_bytes: int = 512 << 20, max_partitions: int = 500_000) -> dict[str, str]:
    """SQL settings sized to the input so every shuffle partition and scan
    split fits comfortably in executor memory: the initial shuffle partition
    count gives ~``partition_bytes`` per partition at full input size (AQE
    coalesces down when stages are smaller), scans split at
    ``scan_split_bytes``, and AQE targets ``partition_bytes`` when it
    coalesces, splits skew or rebalances writes."""
    parts = max(8, min(max_partitions, -(-int(input_bytes) // int(partition_bytes))))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)


@contextmanager
def session_conf(spark: SparkSession, **settings):
    """Temporarily set SQL confs (dotted names given with '__' for '.')."""
    old = {}
    for k, v in settings.items():
        key = k.replace("__", ".")
        old[key] = spark.conf.get(key, None)
        spark.conf.set(key, str(v))
    try:
        yield
    finally:
        for key, v in old.items():
            if v is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, v)
