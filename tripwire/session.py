"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library depends on; applied by ``pin_session``.
_REQUIRED = {
    # Event time has no zone on the wire; every hour/minute computation is UTC.
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tripwire") -> SparkSession:
    """Session for tests and the bench (a cluster passes its own session)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized for the input volume of a cluster run.

    * scan splits of ``target_partition_bytes``;
    * initial shuffle partitions = input / target, at least 2 x total cores
      (AQE coalesces small ones and splits skewed ones at run time); the same
      count is fixed into streaming checkpoints, so choose it before the first
      streaming run;
    * skew-join splitting, RocksDB state with bounded memory, changelog
      checkpointing and no total-row tracking for the streaming state.
    """
    partitions = max(2 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        # skips a read per state write; only the total-rows metric is lost
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }


def pin_session(spark: SparkSession) -> SparkSession:
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-shared scratch area.

    Read from the session's ``spark.checkpoint.dir``.  Only a ``local[...]``
    session without one gets a temporary directory; on a cluster every machine
    would write to a disk of its own, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            raise RuntimeError("spark.checkpoint.dir must name a shared directory") from None
        return root
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a directory that all machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripwire-ckpt-"))
        root = sc.getCheckpointDir()
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def parallelism(spark: SparkSession) -> int:
    """Total task slots of the cluster (falls back to the shuffle partition
    setting where the SparkContext is not reachable)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused directory path below the shared scratch area."""
    root = shared_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
