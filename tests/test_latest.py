"""Stateful streams: late fetches, state and watermark over runs, window counts."""

from __future__ import annotations

import datetime
import json
import random

import pytest

from reelyard.schemas import MOVIE, MOVIE_SCHEMA
from reelyard.session import scale_settings
from reelyard.sinks import snapshot as S
from reelyard.streaming.latest import LANDED_FETCH_SCHEMA, apply_latest_fetches, count_landed_changes


@pytest.fixture(params=[False, True], ids=["memory", "rocksdb"])
def stores_on_disk(spark, request):
    """The state store of a small session, and the one that ``scale_settings`` asks for."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    if request.param:
        spark.conf.set(name, scale_settings(1, 1)[name])
    yield
    spark.conf.set(name, before)


def at(day, hour=0):
    return datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(days=day, hours=hour)


def land(spark, path, rows):
    out = [(i, status, json.dumps({"id": i, "title": title, "genres": [{"id": 1}, {"id": None}]}), t) for i, title, t, status in rows]
    spark.createDataFrame(out, LANDED_FETCH_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def titles(spark, silver):
    return {r.id: r.title for r in S.read_snapshot(spark, silver).collect()}


def test_a_late_older_fetch_never_replaces_a_newer_one(spark, scratch, stores_on_disk):
    silver, landing, ckpt = scratch("silver"), scratch("landing"), scratch("ckpt")
    S.write_snapshot(spark.createDataFrame([(1, "old", "o", "d", "1", []), (9, "kept", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)

    def run():
        apply_latest_fetches(spark, landing, silver, MOVIE, ckpt, delay="2 days", max_files_per_trigger=1)
        return titles(spark, silver)

    land(spark, landing, [(1, "b", at(5), 200), (1, "a", at(4), 200), (2, "x", at(5), 200), (3, "failed", at(5), 500)])
    assert run() == {1: "b", 2: "x", 9: "kept"}
    assert {r.id: r.genre_ids for r in S.read_snapshot(spark, silver).collect()}[1] == [1, None]
    # A second run: older than what the state holds, as old, newer.
    land(spark, landing, [(1, "late", at(4, 5), 200), (2, "tie", at(5), 200), (3, "first", at(4), 200)])
    assert run() == {1: "b", 2: "x", 3: "first", 9: "kept"}
    land(spark, landing, [(1, "c", at(20), 200), (4, "n", None, 200)])
    assert run() == {1: "c", 2: "x", 3: "first", 9: "kept"}
    # The watermark is at day 18 now and ids 2 and 3 are forgotten: what is older is dropped, what is newer wins.
    land(spark, landing, [(2, "too late", at(6), 200), (3, "newer", at(19), 200), (1, "late", at(19), 200)])
    assert run() == {1: "c", 2: "x", 3: "newer", 9: "kept"}
    version = S.current_version(spark, silver)
    assert run() == titles(spark, silver) and S.current_version(spark, silver) == version  # nothing landed


def test_ids_of_one_block_are_told_apart_and_take_one_state(spark, scratch, stores_on_disk):
    """Neighbouring, negative and far ids over two runs equal a plain maximum; there are fewer state rows than ids."""
    silver, landing, ckpt = scratch("silver"), scratch("landing"), scratch("ckpt")
    S.write_snapshot(spark.createDataFrame([(-9, "old", "o", "d", "1", [])], MOVIE_SCHEMA), silver, None)
    draw, known = random.Random(4), {-9: (at(-1), "old")}
    ids = [*range(-300, 700), 2**31 - 1, -(2**31)]
    for run in range(2):
        rows = [(i, f"{run}{draw.randrange(90)}", at(draw.randrange(6)), 200) for i in ids for _ in range(draw.randint(0, 3))]
        land(spark, landing, rows)
        fresh = {}
        for i, title, when, _ in rows:
            fresh[i] = max(fresh.get(i, (when, title)), (when, title))
        for i, (when, title) in fresh.items():
            if i not in known or when > known[i][0]:
                known[i] = (when, title)
        apply_latest_fetches(spark, landing, silver, MOVIE, ckpt, delay="9 days")
        assert titles(spark, silver) == {i: title for i, (_, title) in known.items()}
    state = spark.read.format("statestore").load(ckpt)
    assert 0 < state.count() < len(ids) / 100


def test_window_counts_equal_a_batch_and_drop_what_is_too_late(spark, scratch, stores_on_disk):
    landing, out, ckpt = (scratch(n) for n in ("landing", "out", "ckpt"))
    ddl = "id int, kind string, at timestamp"

    def run(rows):
        df = spark.createDataFrame(rows, ddl)
        df.coalesce(1).write.mode("append").parquet(landing)
        got = count_landed_changes(spark, landing, df.schema, "at", ["kind"], out, ckpt, delay="1 day", max_files_per_trigger=1)
        return {(r.window_start.date().day, r.kind): (r.changes, r.least_id, r.greatest_id) for r in got.collect()}

    assert run([(1, "a", at(0, 3)), (2, "a", at(0, 9)), (3, "b", at(1, 2)), (4, "a", at(1, 5))]) == {}
    # Late, but within the delay: counted in its own day.
    assert run([(9, "a", at(0, 23)), (5, "a", at(2, 1)), (6, None, at(2, 1))]) == {(1, "a"): (3, 1, 9)}
    done = run([(7, "a", at(4, 1)), (8, "a", at(0, 1))])  # the last one is too late: its window was given out
    assert done == {(1, "a"): (3, 1, 9), (2, "b"): (1, 3, 3), (2, "a"): (1, 4, 4), (3, "a"): (1, 5, 5), (3, None): (1, 6, 6)}
