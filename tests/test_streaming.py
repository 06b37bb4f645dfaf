"""Incremental change application: only new landings are applied, once."""

from __future__ import annotations

import json

from reelyard.schemas import MOVIE, MOVIE_SCHEMA
from reelyard.sinks import snapshot as S
from reelyard.streaming.changes import apply_landed_changes


def detail(i, title, status=200):
    body = json.dumps({"id": i, "title": title, "genres": [{"id": i, "name": "g"}]})
    return (i, status, body if status == 200 else "{}")


def land(spark, path, rows):
    spark.createDataFrame(rows, "id int, status int, body string").write.mode("append").parquet(path)


def test_stream_applies_each_landing_once(spark, scratch):
    silver, landing, ckpt = scratch("silver"), scratch("landing"), scratch("ckpt")
    base = spark.createDataFrame([(1, "a", "o", "d", "1", []), (2, "b", "o", "d", "2", [])], MOVIE_SCHEMA)
    S.write_snapshot(base, silver, None)

    land(spark, landing, [detail(2, "b2"), detail(3, "c"), detail(4, "x", status=404)])
    v = apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=ckpt)
    assert v == 2
    got = {r.id: (r.title, r.genre_ids) for r in S.read_snapshot(spark, silver).collect()}
    assert got == {1: ("a", []), 2: ("b2", [2]), 3: ("c", [3])}

    # Nothing new landed: no new version.
    assert apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=ckpt) == 2

    land(spark, landing, [detail(1, "a2")])
    assert apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=ckpt) == 3
    got = {r.id: r.title for r in S.read_snapshot(spark, silver).collect()}
    assert got == {1: "a2", 2: "b2", 3: "c"}


def titles(spark, silver):
    return {r.id: r.title for r in S.read_snapshot(spark, silver).collect()}


def test_default_runs_go_on_where_the_last_one_stopped(spark, scratch):
    silver, landing = scratch("silver"), scratch("landing")
    S.write_snapshot(spark.createDataFrame([(1, "a", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    land(spark, landing, [detail(1, "a2")])
    assert apply_landed_changes(spark, landing, silver, MOVIE) == 2
    land(spark, landing, [detail(3, "c")])
    assert apply_landed_changes(spark, landing, silver, MOVIE) == 3
    assert apply_landed_changes(spark, landing, silver, MOVIE) == 3   # nothing new
    assert titles(spark, silver) == {1: "a2", 3: "c"}


def test_two_feeds_into_one_silver(spark, scratch):
    silver, one, two = scratch("silver"), scratch("one"), scratch("two")
    S.write_snapshot(spark.createDataFrame([(1, "a", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    land(spark, one, [detail(2, "b")])
    land(spark, two, [detail(9, "z")])
    apply_landed_changes(spark, one, silver, MOVIE)
    apply_landed_changes(spark, two, silver, MOVIE, checkpoint=scratch("ckpt"))
    assert titles(spark, silver) == {1: "a", 2: "b", 9: "z"}


def test_a_batch_that_runs_again_after_a_crash_changes_nothing(spark, scratch):
    import shutil

    silver, landing, ckpt = scratch("silver"), scratch("landing"), scratch("ckpt")
    S.write_snapshot(spark.createDataFrame([(1, "a", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    land(spark, landing, [detail(1, "a2"), detail(4, "d")])
    apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=ckpt)
    before = sorted(S.read_snapshot(spark, silver).collect())
    # The stream dies after the switch and before its own commit: the batch is run again.
    shutil.rmtree(ckpt.removeprefix("file:") + "/commits")
    apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=ckpt)
    assert sorted(S.read_snapshot(spark, silver).collect()) == before


def test_newest_fetch_wins_within_a_batch(spark, scratch):
    import time

    silver, landing = scratch("silver"), scratch("landing")
    S.write_snapshot(spark.createDataFrame([(1, "a", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    land(spark, landing, [detail(5, "zzz")])
    time.sleep(1.1)
    land(spark, landing, [detail(5, "aaa")])
    apply_landed_changes(spark, landing, silver, MOVIE, checkpoint=scratch("ckpt"))
    got = {r.id: r.title for r in S.read_snapshot(spark, silver).collect()}
    assert got == {1: "a", 5: "aaa"}


def test_one_version_per_micro_batch(spark, scratch):
    from reelyard.streaming.changes import start_change_stream

    silver, landing = scratch("silver"), scratch("landing")
    S.write_snapshot(spark.createDataFrame([(1, "a", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    land(spark, landing, [detail(2, "b")])
    land(spark, landing, [detail(3, "c")])
    q = start_change_stream(spark, landing, silver, MOVIE, scratch("ckpt"), max_files_per_trigger=1)
    q.awaitTermination()
    assert S.current_version(spark, silver) == 3
    assert sorted(r.id for r in S.read_snapshot(spark, silver).collect()) == [1, 2, 3]
