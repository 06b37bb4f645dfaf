"""Upsert invariants: counts, idempotence, inserts, duplicate change ids, plans."""

from __future__ import annotations

from reelyard.operators import merge as J
from reelyard.operators import profile as G
from reelyard.schemas import MOVIE, MOVIE_SCHEMA
from tests.conftest import plan_text


def movies(spark, rows):
    return spark.createDataFrame(rows, MOVIE_SCHEMA)


BASE = [(1, "a", "o", "2000-01-01", "1.0", [1]), (2, "b", "o", "2000-01-01", "2.0", []),
        (3, "c", "o", "2000-01-01", "3.0", [3])]
CHANGES = [(2, "b2", None, None, "7", None), (9, "new", "o", "2024-01-01", "9.9", [9])]


def test_upsert_replaces_inserts_and_never_deletes(spark):
    out = {r.id: r for r in J.apply_changes(movies(spark, BASE), movies(spark, CHANGES), MOVIE).collect()}
    assert set(out) == {1, 2, 3, 9}
    assert out[2].title == "b2" and out[2].overview == "Sem informação." and out[2].genre_ids == []
    assert out[9].title == "new"
    assert out[1].title == "a"


def test_row_count_is_kept_plus_changes(spark):
    base, ch = movies(spark, BASE), movies(spark, CHANGES)
    merged = J.apply_changes(base, ch, MOVIE)
    kept = J.anti_join(base, ch).count()
    assert merged.count() == kept + ch.count()
    r = G.merge_counts(base, ch, merged).collect()[0]
    assert (r.original_rows, r.change_rows, r.updated_rows) == (3, 2, 4)


def test_applying_twice_equals_applying_once(spark):
    base, ch = movies(spark, BASE), movies(spark, CHANGES)
    once = J.apply_changes(base, ch, MOVIE)
    twice = J.apply_changes(once, ch, MOVIE)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_duplicate_change_ids_resolve_to_one_row(spark):
    dup = CHANGES + [(2, "b3", None, None, "7", None)]
    out = J.apply_changes(movies(spark, BASE), movies(spark, dup), MOVIE).collect()
    assert sorted(r.id for r in out) == [1, 2, 3, 9]
    assert [r.title for r in out if r.id == 2] == ["b3"]


def test_change_without_title_is_dropped_before_merge(spark):
    ch = [(1, None, "x", None, None, None)]
    out = {r.id: r.title for r in J.apply_changes(movies(spark, BASE), movies(spark, ch), MOVIE).collect()}
    assert out[1] == "a"


def test_null_left_key_is_kept_by_anti_join(spark):
    left = movies(spark, [(None, "x", None, None, None, None), (1, "a", None, None, None, None)])
    right = movies(spark, [(1, "z", None, None, None, None), (None, "q", None, None, None, None)])
    out = J.anti_join(left, right).collect()
    assert [(r.id, r.title) for r in out] == [(None, "x")]


def test_anti_join_broadcasts_small_key_side(spark):
    plan = plan_text(J.anti_join(movies(spark, BASE), movies(spark, CHANGES)))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_anti_join_above_bound_shuffles_and_agrees(spark):
    base, ch = movies(spark, BASE), movies(spark, CHANGES)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = J.anti_join(base, ch, broadcast_bytes=1)
        plan = plan_text(big)
        assert "BroadcastHashJoin" not in plan
        assert sorted(big.collect()) == sorted(J.anti_join(base, ch).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tv_changes_keep_silver_column_order(spark):
    from reelyard.schemas import TV, TV_SCHEMA

    base = spark.createDataFrame([([1], 1, ["US"], "en", "o", "x", "d", "n", 1.0)], TV_SCHEMA)
    ch = spark.createDataFrame([(None, 1, None, None, None, None, None, "m", None)], TV_SCHEMA)
    out = J.apply_changes(base, ch, TV)
    assert out.columns == TV.silver_order
    r = out.collect()[0]
    assert (r.name, r.original_name, r.vote_average, r.genre_ids) == ("m", "m", 0.0, [])
