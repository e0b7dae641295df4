"""Session helpers: local settings for tests and benches, checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stockcast") -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session you get."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local master (tests, single machine) gets a scratch folder when the
    setting is unset; on a cluster a machine-local folder would be wrong, so
    the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(the restock plan cuts lineage with reliable checkpoints)")
        current = tempfile.mkdtemp(prefix="stockcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


MB = 1024 * 1024


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 * MB,
                   shuffle_share: float = 0.3) -> dict[str, str]:
    """SQL settings sized for an input of ``input_bytes`` on ``total_cores`` task slots.

    Scan splits of ``partition_bytes``; shuffle partitions so that the
    exchanged data (``shuffle_share`` of the input after column pruning and
    map-side aggregation) lands at about ``partition_bytes`` per task, never
    fewer than 2 per core; AQE coalesces small ones and splits skewed ones at
    run time. For 100 TB on 8,000 cores this gives ~120k shuffle partitions.
    """
    shuffle = max(2 * total_cores, int(input_bytes * shuffle_share // partition_bytes) + 1)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
    }


def apply_scale_settings(spark: SparkSession, input_bytes: int, total_cores: int | None = None) -> dict[str, str]:
    """Set ``scale_settings`` on the session (SQL settings only, changeable at run time)."""
    conf = scale_settings(input_bytes, total_cores or spark.sparkContext.defaultParallelism)
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf
