"""Session helpers: a local session for tests and benches, and the shared
scratch folder for written intermediates.

Library functions never create a session; they take the caller's.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "varlake") -> SparkSession:
    """A local session for tests and benches (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediates (``spark.checkpoint.dir``).

    Read from the session; where it is unset, a local session, whose tasks
    run in the driver's own process, gets a fresh folder, and any other
    master is an error: a folder on one machine is not shared."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the checkpoint root for one written
    table (never reused, so concurrent or retried jobs do not collide)."""
    return f"{checkpoint_root(spark)}/varlake-{label}-{uuid.uuid4().hex[:12]}"


def cluster_conf(total_cores: int, shuffle_bytes: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a large cluster, to pass to ``SparkSession.builder``
    or spark-submit (the library itself sets none).

    Shuffle partitions start at about ``shuffle_bytes`` / 128 MB (at least
    two waves of ``total_cores``) and AQE coalesces them to the measured
    size, so a task's shuffle input fits executor memory; AQE also splits
    skewed join partitions and turns joins into broadcasts from measured
    sizes only.
    """
    initial = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
