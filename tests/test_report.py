"""Rolled-up walk ends, distinct sketches, top titles."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelyard.operators import report as T
from tests.conftest import plan_text


def test_rollup_levels(spark):
    cuts = spark.createDataFrame([("1999-01-01", 3, "last_page"), ("1999-05-01", 1, "missing_page"), ("2001-01-01", 2, "last_page"), ("no day", 5, "last_page")], "day string, cut int, ended string")
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        cuts = cuts.where("day <> 'no day'")
    rows = {(r.level, r.decade, r.year, r.ended): (r.days, r.pages) for r in T.walk_end_rollup(cuts).collect()}
    assert rows[0, 1990, 1999, "last_page"] == (1, 2) and rows[1, 1990, 1999, None] == (2, 2)
    assert rows[3, 2000, None, None] == (1, 1) and rows[7, None, None, None][0] == cuts.count()
    assert T.walk_end_rollup(cuts.limit(0)).where("level < 7").collect() == []


def test_merged_sketches_keep_their_error_bound(spark):
    """Slices overlap, so only merging (not adding) gives the distinct count."""
    rows = spark.range(60_000).select((F.col("id") % 40_000).alias("v"), (F.col("id") % 7).alias("s"))
    sketches = T.distinct_sketches(rows, "v", ["s"])
    (one,) = T.merged_distinct(sketches.withColumn("all", F.lit(1)), ["all"]).collect()
    assert abs(one.estimate / 40_000 - 1) < 3 * T.STANDARD_ERROR
    per = {r.s: r.estimate for r in T.merged_distinct(sketches, ["s"]).collect()}
    exact = {r.s: r.n for r in rows.groupBy("s").agg(F.countDistinct("v").alias("n")).collect()}
    assert all(abs(per[s] / exact[s] - 1) < 3 * T.STANDARD_ERROR for s in exact)
    assert T.merged_distinct(T.distinct_sketches(rows.limit(0), "v", ["s"]), ["s"]).collect() == []


def test_top_k_limits_groups_before_the_shuffle(spark):
    rows = spark.createDataFrame([(g, i, i % 3) for g in (1, 2, None) for i in range(20)], "g int, id int, r int").repartition(4)
    top = T.top_k(rows, ["g"], [F.col("r").desc(), F.col("id")], 4)
    plan = plan_text(top, "simple")
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan[plan.index("Exchange"):]
    assert sorted((r.g or 0, r["rank"], r.id) for r in top.collect()) == [(g, k + 1, i) for g in (0, 1, 2) for k, i in enumerate([2, 5, 8, 11])]
