"""Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

BLOCK_SIZE = 256 * 1024 * 1024


def sink_bronze(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite one Parquet dataset (W1); returns the rows written.

    With ``partition_by`` only the partitions present in ``df`` are replaced
    (dynamic partition overwrite), so decade slices are independent.  The row
    count is observed during the write, not by a second job.
    """
    obs = Observation("sink_bronze")
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return int(obs.get["rows"])


def path_exists(spark, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark, path: str) -> None:
    """Remove a file or folder through the Hadoop file system, if it is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def sink_silver(df: DataFrame, path: str, files: int | None = None,
                block_size: int = BLOCK_SIZE) -> int:
    """Overwrite a silver dataset with large row groups (W2); returns rows.

    ``files`` fixes the number of output files (a round-robin shuffle); leave
    it unset at scale so the file count follows the data (AQE-coalesced
    partitions), which avoids an extra full shuffle.
    """
    obs = Observation("sink_silver")
    if files is not None:
        df = df.repartition(files)
    # Observed in the write's own stage: a map stage that runs again cannot count twice.
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (out.write.mode("overwrite")
        .option("parquet.block.size", block_size)
        .option("compression", "snappy")
        .parquet(path))
    return int(obs.get["rows"])


def preview(df: DataFrame, n: int = 10, order_by: tuple[str, ...] = ("id",)) -> DataFrame:
    """The first ``n`` rows in key order (W6): a top-n, not a full sort."""
    return df.orderBy(*order_by).limit(n)
