"""Session-level helpers: recommended configuration and the shared folder.

The library never creates or stops a session for a caller. ``build_session``
exists for the bench and the tests only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed around. AQE re-plans joins from
# runtime sizes, coalesces small shuffle partitions and splits skewed join
# partitions; ANSI stays on (load boundaries use try_* functions).
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when the frames that read them go
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run, from the input volume.

    Scan splits and shuffle partitions target ``target_partition_bytes`` so
    that a task's working set fits in executor memory without spilling;
    AQE starts from that many shuffle partitions (never fewer than 2x the
    cores) and coalesces small ones at run time. For 100 TB on 1000
    executors x 8 cores this gives ~800k initial shuffle partitions.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "blotter") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, taken from ``spark.checkpoint.dir``.

    On a cluster this must name a distributed file system path; it is read
    from the session. Only when it is unset and the master is local, a
    private folder under the system temp directory is created and
    registered; on a cluster executors couldn't see that, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local_master(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="blotter-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/blotter-{name}-{uuid.uuid4().hex}"


def is_local_master(spark: SparkSession) -> bool:
    """One JVM runs everything (local-cluster starts executors of their own)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any Hadoop file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


__all__ = ["RECOMMENDED_CONF", "scale_conf", "build_session", "shared_dir", "scratch_path", "delete_path", "is_local_master"]
