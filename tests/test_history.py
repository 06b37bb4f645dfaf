"""Snapshot differences, validity intervals and as-of joins against plain Python."""

from __future__ import annotations

import bisect
import random

import pytest
from pyspark.sql import functions as F

from reelyard.operators import history as H
from reelyard.schemas import MOVIE_SCHEMA
from tests.conftest import plan_text

OLD = [(1, "a", None, "d", "1", [1]), (2, "b", "", "d", "1", []), (3, "c", "o", "d", None, [1, None]), (4, "same", "o", "d", "1", None),
       (None, "n", "o", "d", "1", [])]
NEW = [(1, "a", "", "d", "1", [1]), (3, "c", "o", "d", None, [1]), (4, "same", "o", "d", "1", None), (5, "e", None, None, None, None),
       (None, "n2", "o", "d", "1", [])]


def frames(spark, *tables):
    return [spark.createDataFrame(t, MOVIE_SCHEMA) for t in tables]


def test_diff_tells_null_from_empty_and_replays(spark):
    old, new = frames(spark, OLD, NEW)
    assert {(r.id, r.change) for r in H.snapshot_diff(old, new.select(*reversed(new.columns))).collect()} == {
        (1, "changed"), (2, "deleted"), (3, "changed"), (5, "inserted"), (None, "changed")}
    for limit in (H.DEFAULT_BROADCAST_BYTES, 0):
        for a, b in ((old, new), (new, old), (old, old), (old, new.limit(0)), (old.limit(0), new)):
            delta = H.snapshot_delta(a, b, broadcast_bytes=limit)
            got = H.replay(a, delta, broadcast_bytes=limit)
            assert sorted(map(str, got.collect())) == sorted(map(str, b.collect()))
    assert H.snapshot_diff(old, old).collect() == []
    with pytest.raises(ValueError):
        H.snapshot_diff(old, new.drop("title"))


def test_diff_shuffles_fingerprints_only(spark):
    old, new = frames(spark, OLD, NEW)
    plan = plan_text(H.snapshot_diff(old, new))
    for line in plan.splitlines():
        if line.strip().startswith("Input") and "hashpartitioning" in line:
            assert "overview" not in line
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def versions_of(seed=1, keys=6, n=200):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        k = draw.choice([0, 0, draw.randrange(keys), None])  # key 0 holds a third and more
        rows.append((k, draw.choice([None, *range(0, 4_000_000, 40_000)]), draw.choice(["x", "y", None]), draw.choice([1, 2, None])))
    return rows + rows[:10]


def version_frame(spark, rows):
    df = spark.createDataFrame(rows, "id int, s long, title string, rating int").repartition(3)
    return df.withColumn("at", F.timestamp_seconds("s"))


def low(state):
    return tuple((v is not None, v) for v in state)


def states_of(rows):
    """Per key: times and greatest states, ascending."""
    best = {}
    for k, s, t, r in rows:
        if k is not None and s is not None:
            best[k, s] = max(best.get((k, s), (t, r)), (t, r), key=low)
    out = {}
    for (k, s), state in sorted(best.items()):
        out.setdefault(k, []).append((s, state))
    return out


@pytest.mark.parametrize("width", [10**9, 100_000, 1])
def test_validity_intervals(spark, width):
    rows = versions_of()
    want = set()
    for k, states in states_of(rows).items():
        kept = [x for i, x in enumerate(states) if i == 0 or states[i - 1][1] != x[1]]
        want |= {(k, *x[1], x[0], nxt[0] if nxt else None) for x, nxt in zip(kept, [*kept[1:], None], strict=True)}
    got = H.validity_intervals(version_frame(spark, rows), "id", "at", ["title", "rating"], width)
    got = [(r.id, r.title, r.rating, r.f, r.t) for r in got.withColumns({"f": F.unix_seconds("valid_from"), "t": F.unix_seconds("valid_to")}).collect()]
    assert set(got) == want and len(got) == len(want)


@pytest.mark.parametrize("width", [10**9, 100_000])
def test_as_of_join(spark, width):
    draw = random.Random(5)
    rows = versions_of(2)
    events = [(i, draw.choice([0, 0, 1, 2, 77, None]), draw.choice([None, *range(-50_000, 4_200_000, 20_000)])) for i in range(300)]
    events += events[:5]
    states = states_of(rows)

    def found(k, s):
        if k not in states or s is None:
            return (None, None)
        at = bisect.bisect_right([x[0] for x in states[k]], s) - 1
        return states[k][at][1] if at >= 0 else (None, None)

    left = spark.createDataFrame(events, "event int, id int, es long").withColumn("when", F.timestamp_seconds("es")).repartition(3)
    out = H.as_of_join(left, version_frame(spark, rows), "id", "when", "at", ["title", "rating"], width)
    assert out.columns == ["event", "id", "es", "when", "title", "rating"]
    assert sorted(map(str, ((r.event, r.id, r.es, r.title, r.rating) for r in out.collect()))) == sorted(map(str, ((e, k, s, *found(k, s)) for e, k, s in events)))
    empty = H.as_of_join(left, version_frame(spark, rows).limit(0), "id", "when", "at", ["title"], width)
    assert empty.count() == len(events) and empty.where("title IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        H.as_of_join(left.withColumn("title", F.lit(1)), version_frame(spark, rows), "id", "when", "at", ["title"])


def test_a_hot_key_is_split_by_time(spark):
    left = spark.range(10).select(F.lit(1).alias("id"), F.timestamp_seconds(F.col("id") * 5000).alias("when"))
    plan = plan_text(H.as_of_join(left, version_frame(spark, versions_of()), "id", "when", "at", ["title"]))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    windows = [x for x in plan.splitlines() if "hashpartitioning(id" in x and "_bucket" in x]
    assert windows  # the walk is by key and bucket
