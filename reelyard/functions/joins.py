"""Join-side sizing: broadcast only what has a proven size bound."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

# A broadcast side holds at most this many bytes of rows (``estimated_bytes``);
# the hashed relation built from them takes a few times that on every executor.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

# What a row costs besides its values.
ROW_OVERHEAD = 16


class Stored(NamedTuple):
    """A stored table, its row count and the estimated size of its rows."""

    df: DataFrame
    rows: int
    bytes: int


def _measured(df: DataFrame) -> list:
    """Row count, and total bytes of the columns whose width is not fixed."""
    wide = [F.octet_length(F.col(f.name)) if isinstance(f.dataType, StringType)
            else F.octet_length(F.to_json(F.struct(f.name)))
            for f in df.schema.fields
            if isinstance(f.dataType, (StringType, ArrayType, MapType, StructType))]
    total = sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(0).cast("long"))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(total), F.lit(0)).alias("wide_bytes")]


def _fixed_width(df: DataFrame) -> int:
    """Bytes of a row besides its wide values (eight for every column)."""
    return ROW_OVERHEAD + 8 * len(df.schema.fields)


def store_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder, for frames that
    are read several times and never broadcast (no size is measured)."""
    from reelyard.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_table(df: DataFrame, name: str) -> Stored:
    """Compute ``df`` once into a Parquet table in the shared scratch folder;
    return a scan of it with its row count and size (observed during the write).

    This cuts the lineage (a lost executor re-reads the table instead of
    recomputing the upstream) and, unlike ``Dataset.checkpoint``, computes the
    input only once.  The scan carries exact file-size statistics; the schema
    is declared, so no footer is read to infer it.
    """
    from reelyard.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    obs = Observation(f"materialize_{name}")
    df.observe(obs, *_measured(df)).write.mode("errorifexists").parquet(path)
    rows = int(obs.get["rows"])
    size = rows * _fixed_width(df) + int(obs.get["wide_bytes"])
    return Stored(spark.read.schema(df.schema).parquet(path), rows, size)


def bounded_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                      materialize: bool = False) -> tuple[DataFrame, bool]:
    """Hint ``df`` for broadcast if its rows take at most ``max_bytes``.

    The check reads at most as many rows as could fit (``limit`` before the
    aggregate), so it is bounded work even when the side turns out to be large.
    Above the bound the frame is returned unhinted and Spark plans a shuffle
    join, which AQE may still convert or split for skew.

    ``materialize`` first writes a derived side as a table under the shared
    ``spark.checkpoint.dir``, so the size check and the join read the same
    stored rows instead of computing the side's whole lineage twice.
    """
    if max_bytes <= 0:
        return df, False
    if materialize:
        df, _, size = materialize_table(df, "side")
    else:
        width = _fixed_width(df)
        found = df.limit(max_bytes // width + 1).agg(*_measured(df)).first()
        size = found["rows"] * width + found["wide_bytes"]
    return (F.broadcast(df), True) if size <= max_bytes else (df, False)
