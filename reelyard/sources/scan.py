"""Parquet scans of catalogue datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_path(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """One Parquet dataset.  A declared schema skips footer inference."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def scan_glob(spark: SparkSession, root: str, prefix: str,
              slice_column: str | None = None, schema: StructType | None = None,
              version_column: str | None = None) -> DataFrame:
    """Every slice directory ``<root>/<prefix>*`` of one media type as one table.

    ``movie_*`` matches ``movie_1970`` but not ``movies_changes``.  Files are
    looked up recursively, so plain slice directories and a ``decade=``
    partitioned backfill can sit side by side (partition columns are not
    inferred).  With ``slice_column`` the slice path each row came from (the
    directory plus any ``k=v`` partition directories) is added from the hidden
    ``_metadata`` column, so the scan stays a plain file scan with pushdown and
    pruning.  ``version_column`` adds when the row's file was written
    (microseconds), then its path: the version order when slices overlap, so a
    slice written later wins whatever its name.  With a declared ``schema`` no footer is read for inference, and slices that hold
    no rows (an empty backfill) read as zero rows instead of failing.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(f"{root.rstrip('/')}/{prefix}*")
    if version_column:
        df = df.withColumn(version_column, F.struct(
            F.unix_micros("_metadata.file_modification_time").alias("written"),
            F.col("_metadata.file_path").alias("path")))
    if slice_column:
        df = df.withColumn(
            slice_column,
            F.regexp_extract(F.col("_metadata.file_path"),
                             rf"/({prefix}[^/]*(?:/[^/=]+=[^/]*)*)/[^/]+$", 1),
        )
    return df


def register_view(df: DataFrame, name: str) -> str:
    """Expose a dataset to SQL text (``spark.sql("SELECT ... FROM name")``)."""
    df.createOrReplaceTempView(name)
    return name
