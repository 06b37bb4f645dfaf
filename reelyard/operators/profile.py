"""Data-quality metrics (G1-G5), each one aggregate pass.

The reference logs these through 8-16 separate actions per run; here every
metric is a single global aggregate (partial per task, one tiny final merge),
and the pipelines collect them for free during the write with ``observe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelyard.operators.clean import valid_rows
from reelyard.schemas import MediaSpec


def null_count_columns(columns: list[str]) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: per column the number of nulls (bigint; 0 on an empty input)."""
    return df.agg(*null_count_columns(columns or df.columns))


def null_profile_long(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: ``column_name, null_count``."""
    cols = columns or df.columns
    return null_profile(df, cols).unpivot([], cols, "column_name", "null_count")


def row_count(df: DataFrame) -> DataFrame:
    """``row_count``: all rows, nulls included."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def removed_counts(raw: DataFrame, spec: MediaSpec, key: str = "id") -> DataFrame:
    """Rows removed by the validity rule and by de-duplication, in one pass.

    ``input_rows, removed_invalid, removed_duplicates, output_rows``.  The
    distinct count shuffles only the key (partially aggregated per task).
    """
    ok = valid_rows(spec)
    return (raw.agg(F.count(F.lit(1)).alias("input_rows"),
                    F.count_if(~ok).alias("removed_invalid"),
                    F.count_if(ok).alias("_valid"),
                    F.count_distinct(F.when(ok, F.col(key))).alias("output_rows"))
            .select("input_rows", "removed_invalid",
                    (F.col("_valid") - F.col("output_rows")).alias("removed_duplicates"),
                    "output_rows"))


def merge_counts(original: DataFrame, changes: DataFrame, updated: DataFrame) -> DataFrame:
    """``original_rows, change_rows, updated_rows`` as one row, one job."""
    tagged = (original.select(F.lit(0).alias("_src"))
              .unionByName(changes.select(F.lit(1).alias("_src")))
              .unionByName(updated.select(F.lit(2).alias("_src"))))
    return tagged.agg(F.count_if(F.col("_src") == 0).alias("original_rows"),
                      F.count_if(F.col("_src") == 1).alias("change_rows"),
                      F.count_if(F.col("_src") == 2).alias("updated_rows"))
