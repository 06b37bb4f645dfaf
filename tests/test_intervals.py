"""Day ranges and overlap joins against plain Python."""

from __future__ import annotations

import datetime
import random

import pytest

from reelyard.operators import intervals as R
from tests.conftest import plan_text

D0 = datetime.date(1999, 12, 1)


def day(n):
    return D0 + datetime.timedelta(days=n)


def test_day_ranges(spark):
    draw = random.Random(1)
    rows = [(draw.choice(["a", "a", None]), day(draw.randrange(120)).isoformat()) for _ in range(150)] + [("a", None), ("b", day(0).isoformat())]
    got = R.day_ranges(spark.createDataFrame(rows, "k string, day string").repartition(3), keys=("k",)).collect()
    want = set()
    for k in {"a", "b", None}:
        days = sorted({datetime.date.fromisoformat(d) for kk, d in rows if kk == k and d})
        start = prev = None
        for d in [*days, None]:
            if prev is not None and (d is None or (d - prev).days > 1):
                want.add((k, start, prev, (prev - start).days + 1))
                start = d
            start, prev = start or d, d
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert R.day_ranges(spark.createDataFrame([], "day string")).collect() == []


def ranges(seed, n):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        a = draw.randrange(-400, 900)
        out.append((i, draw.choice("xyz"), day(a), day(a + draw.choice([0, 0, 1, 3, 17, 200, 1000, -1]))))
    return out + [(n, "x", None, day(1)), (n + 1, "x", day(1), None), (n + 2, None, day(1), day(5))]


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_overlap_join(spark, keys):
    left, right = ranges(1, 80), ranges(2, 60)
    a = spark.createDataFrame(left, "l int, k string, a date, b date").repartition(3)
    b = spark.createDataFrame(right, "r int, k string, c date, d date").repartition(2)
    if not keys:
        a, b = a.drop("k"), b.drop("k")

    def meet(x, y):
        return None not in (x[2], x[3], y[2], y[3]) and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3] and (not keys or (x[1] is not None and x[1] == y[1]))

    out = R.overlap_join(a, b, ("a", "b"), ("c", "d"), keys)
    got = [(r.l, r.r) for r in out.collect()]
    assert sorted(got) == sorted((x[0], y[0]) for x in left for y in right if meet(x, y))
    plan = plan_text(out)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert R.overlap_join(a.limit(0), b, ("a", "b"), ("c", "d"), keys).collect() == []


def test_long_intervals_do_not_multiply_what_is_compared(spark):
    """One interval of all days beside many single days: bins touched stay within two a level."""
    a = spark.createDataFrame([(0, day(0), day(200_000))], "l int, a date, b date")
    top = (200_001).bit_length()
    assert R._binned(a, "left", "a", "b", top).count() <= 4
    ones = spark.range(3000).selectExpr("CAST(id AS INT) AS r", "date_add(DATE '1999-12-01', CAST(id * 40 AS INT)) AS c").selectExpr("r", "c", "c AS d")
    assert R._binned(ones, "right", "c", "d", top).count() == 3000 * (top + 1)
    assert R.overlap_join(a, ones, ("a", "b"), ("c", "d")).count() == 3000
    with pytest.raises(ValueError):
        R.overlap_join(a, a, ("a", "b"), ("a", "b"))
