"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. The session time zone is part of the
# semantics: days and `mm:ss` labels are taken in UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture costs JVM round trips on every Column call.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = "local[*]", app: str = "clicklens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster pass ``master=None`` (the
    launcher sets it) and ``extra=scale_conf(...)``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone; days and clock labels are defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.
    Where it is unset, a ``local[...]`` session (driver and executors in one
    process) gets a temporary one; on a cluster that would be each machine's
    own disk, so it is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        base = sc.getCheckpointDir()
        if not base:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="clicklens-ckpt-")
            sc.setCheckpointDir(base)
            base = sc.getCheckpointDir() or base
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    return f"{path}/{uuid.uuid4().hex}"



MB = 1 << 20


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               shuffle_fraction: float = 0.3, partition_mb: int = 256) -> dict[str, str]:
    """Settings for a cluster run, derived from the input size and cluster shape.

    * ``spark.sql.shuffle.partitions``: the widest shuffle here carries about
      ``shuffle_fraction`` of the input (four or five narrow columns of the
      visit or click rows), cut into ``partition_mb`` pieces, and never fewer
      than three waves of the cluster's cores; AQE then coalesces small ones
      toward the advisory size.
    * ``spark.sql.files.maxPartitionBytes``: scan splits of ``partition_mb``.
    * skew: a partition five times the advisory size (and over 1 GB) is split
      by AQE's skew join.
    * group limit: ``row_number() <= n`` is limited before the shuffle for any n.
    * state: RocksDB state store with changelog checkpointing, so the ban and
      totals state does not live on the JVM heap and checkpoints stay small.
    """
    cores = max(1, executors * cores_per_executor)
    by_size = -(-int(input_bytes * shuffle_fraction) // (partition_mb * MB))
    parts = max(3 * cores, by_size)
    parts = -(-parts // cores) * cores          # whole waves
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{max(1024, 4 * partition_mb)}m",
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
