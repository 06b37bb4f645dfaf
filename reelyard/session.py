"""Session construction and the shared scratch location.

Cluster jobs get their session from the launcher; ``local_session`` is for
tests and the bench.  Scratch data (checkpoints, materialised fixtures) always
lives under ``spark.checkpoint.dir`` so that it is on the shared file system the
cluster names, never on one machine's local disk.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "reelyard") -> SparkSession:
    """A local session configured like the cluster profile (AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "snappy")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


MB = 1024 * 1024


def scale_settings(input_bytes: int, slots: int, most_reducers: int | None = None) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of Parquet on ``slots``
    executor cores.

    Scans split at 256 MB (compressed; payload text expands a few times in
    memory, which a 6 GB / 1-core executor absorbs).  The initial shuffle
    width gives ~512 MB per reducer for a full-width shuffle of the input (the
    de-duplication is the only one; its sort spills) and at least two waves of
    tasks; AQE then coalesces small partitions towards 256 MB and splits skewed
    partitions of joins.  ``most_reducers`` bounds the width for a driver that
    cannot hold the map-output metadata; each reducer then gets more data.
    """
    scan = 256 * MB
    shuffle = max(2 * slots, -(-input_bytes // (512 * MB)))
    if most_reducers is not None:
        shuffle = min(shuffle, most_reducers)
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MB),
        "spark.sql.session.timeZone": "UTC",
        # Stream state on disk: it need not fit in an executor's memory.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }


def tune_for_input(spark: SparkSession, input_bytes: int, slots: int | None = None) -> None:
    """Apply ``scale_settings`` to a running session."""
    for k, v in scale_settings(input_bytes, slots or spark.sparkContext.defaultParallelism).items():
        spark.conf.set(k, v)


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area: ``spark.checkpoint.dir`` as the cluster
    sets it, else the session's checkpoint directory (``setCheckpointDir``)."""
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(f"side tables need a folder that driver and executors share: set {CHECKPOINT_CONF}, "
                           "or call SparkContext.setCheckpointDir")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared scratch root."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
