"""Small Spark helpers of the operators: table reads, Arrow map steps, stored side tables, labelled samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bounds of an Arrow batch: long texts make large rows, so batches are bounded in bytes too.
BATCH_ROWS, BATCH_BYTES = 4000, 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def shared_folder(spark: SparkSession) -> str:
    """A new path below the folder that driver and executors share (``spark.checkpoint.dir``)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def store(df: DataFrame, at: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: later steps re-read it, also after lost executors."""
    spark = df.sparkSession
    path = at or shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` stored once like ``store``, in as many buckets of ``key`` as a shuffle has partitions.

    Joins and aggregates by ``key`` read it in place, without shuffling it again.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return spark.table(name)


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove stored tables that nothing reads any more."""
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id as text, modulo 5: the fold rule of the held-out documents."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def bounded_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled rows, those of the smallest id hashes: the same rows in any layout."""
    return labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
