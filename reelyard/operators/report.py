"""Catalogue reports: rolled-up walk ends, mergeable distinct counts, top titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelyard.operators.ingest import decade_of

# Sketches of 2**LG_K registers: merged estimates have a relative standard error
# of 1.04 / sqrt(2**LG_K), 1.6 %.
LG_K = 12
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)


def walk_end_rollup(cuts: DataFrame) -> DataFrame:
    """Days by walk end, with subtotals: ``decade, year, ended, level, days, pages``.

    ``level`` is 0 for (decade, year, end), 1 for a year, 3 for a decade, 7 for
    all days (``grouping_id``).  ``cuts`` has a row per day, so the fan-out of the
    rollup is four rows a day before the partial aggregate.
    """
    days = cuts.select(decade_of("day").alias("decade"), F.year(F.to_date("day")).alias("year"), "ended",
                       (F.col("cut") - 1).cast("long").alias("_pages"))
    return (days.rollup("decade", "year", "ended")
            .agg(F.grouping_id().cast("int").alias("level"), F.count(F.lit(1)).alias("days"),
                 F.sum("_pages").alias("pages")))


def distinct_sketches(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``by, sketch``: a HyperLogLog sketch of the distinct values of each group, to be stored and merged."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(value), F.lit(LG_K)).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by, estimate``: distinct values of merged groups, from the stored sketches alone."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group in ``order`` (which must leave no ties), with ``rank``.

    Spark limits every task's rows to ``k`` per group before the shuffle, so a
    group that holds a third of all rows sends ``k`` rows per task.
    """
    if k < 1:
        raise ValueError("k is 1 at least")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)
