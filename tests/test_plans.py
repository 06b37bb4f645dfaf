"""Plan shape of the two scale-critical jobs, read from ``explain``."""

from __future__ import annotations

from reelyard import fixtures as fx
from reelyard.operators.ingest import (
    changed_pages,
    flatten_pages,
    lookback_days,
    reshape_details,
    stored_pages,
    typed_details,
)
from reelyard.operators.merge import anti_join
from reelyard.plans import pipelines as P
from reelyard.plans.queries import silver_movies
from reelyard.schemas import CHANGE_ITEM, MOVIE, TV
from reelyard.sinks.write import sink_bronze
from reelyard.sources.records import typed_pages
from tests.conftest import SMOKE, plan_text


def test_merge_streams_silver_through_a_broadcast_anti_join(spark, scratch):
    silver, changes = scratch("silver"), scratch("changes")
    silver_movies(spark, SMOKE).write.parquet(silver)
    sink_bronze(fx.movie_changes(spark, SMOKE), changes)
    merged, _, n = P.merged_frame(spark.read.parquet(silver), spark.read.parquet(changes), MOVIE)
    plan = plan_text(merged, "simple")
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    silver_side = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in silver_side
    assert "PushedFilters: [IsNotNull(id), IsNotNull(title)]" in plan


def test_tv_details_are_parsed_once(spark):
    ok = fx.tv_details(spark, SMOKE).where("status = 200")
    for spec in (MOVIE, TV):
        plan = plan_text(reshape_details(typed_details(ok, spec), spec), "simple")
        assert plan.count("from_json(") == 1


def test_the_walk_reads_stored_pages(spark):
    pages = stored_pages(typed_pages(fx.change_pages(spark, SMOKE), CHANGE_ITEM))
    assert "from_json(" not in plan_text(flatten_pages(changed_pages(pages)), "simple")


def test_look_back_reaches_the_scan(spark, scratch):
    path = scratch("pages")
    fx.change_pages(spark, SMOKE).write.parquet(path)
    plan = plan_text(lookback_days(spark.read.parquet(path), "day", 3, "2024-01-10"), "simple")
    assert "GreaterThanOrEqual(day,2024-01-07)" in plan


def test_no_broadcast_beyond_the_bound(spark):
    left, right = spark.range(1000), spark.range(10)
    assert "BroadcastHashJoin" in plan_text(anti_join(left, right), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_text(anti_join(left, right, broadcast_bytes=100), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
