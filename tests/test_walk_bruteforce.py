"""The set-oriented page walks equal a page-by-page walk on a small fixture."""

from __future__ import annotations

import json
from collections import defaultdict

from reelyard import fixtures as fx
from reelyard.operators import ingest as I
from reelyard.schemas import CHANGE_ITEM, MOVIE
from reelyard.sources.records import typed_pages
from tests.conftest import SMOKE


def readable(body):
    try:
        json.loads(body)
    except ValueError:
        return False
    return True


def walk(pages, stop_on_empty, cap):
    """Sequential walk per day, as a crawler would fetch: 1, 2, ..."""
    by_day = defaultdict(dict)
    for day, page, status, body in pages:
        by_day[day][page] = (status, body)
    kept = set()
    for day, got in by_day.items():
        page, last = 1, 1
        while page <= last:
            if page not in got:
                break
            status, body = got[page]
            if status != 200 or not readable(body):
                break
            data = json.loads(body)
            if stop_on_empty and not data.get("results"):
                break
            kept.add((day, page))
            last = data.get("total_pages") or 1
            if cap is not None:
                last = min(last, cap)
            if stop_on_empty and page >= last:
                break
            page += 1
    return kept


def spark_walk(df):
    return {(r.day, r.page) for r in df.select("day", "page").collect()}


def test_discover_walk_equals_sequential_walk(spark):
    landed = fx.discover_movie_pages(spark, SMOKE)
    rows = [tuple(r) for r in landed.collect()]
    got = spark_walk(I.contiguous_pages(typed_pages(landed, MOVIE.schema)))
    assert got == walk(rows, stop_on_empty=True, cap=None)
    assert 0 < len(got) < len(rows)


def test_change_walk_equals_sequential_walk(spark):
    landed = fx.change_pages(spark, SMOKE)
    rows = [tuple(r) for r in landed.collect()]
    for cap in (500, 20):
        got = spark_walk(I.changed_pages(typed_pages(landed, CHANGE_ITEM), cap))
        assert got == walk(rows, stop_on_empty=False, cap=cap)


def walk_reasons(pages, stop_on_empty, cap):
    """Why the sequential walk of each day stopped."""
    by_day = defaultdict(dict)
    for day, page, status, body in pages:
        by_day[day][page] = (status, body)
    out = {}
    for day, got in by_day.items():
        if not any(p >= 1 for p in got):
            continue
        page, last, more, reason = 1, 1, False, None
        while reason is None:
            if page > last:
                reason = "page_cap" if more else "last_page"
            elif page not in got:
                reason = "missing_page"
            elif got[page][0] != 200 or not readable(got[page][1]):
                reason = "failed_page"
            else:
                data = json.loads(got[page][1])
                if stop_on_empty and not data.get("results"):
                    reason = "empty_page"
                else:
                    last = data.get("total_pages") or 1
                    more = cap is not None and last > cap
                    if more:
                        last = cap
                    page += 1
        out[day] = reason
    return out


def test_walk_ends_equal_sequential_walk(spark):
    for landed, record, stop, cap in ((fx.discover_movie_pages(spark, SMOKE), MOVIE.schema, True, None),
                                      (fx.change_pages(spark, SMOKE), CHANGE_ITEM, False, 500),
                                      (fx.change_pages(spark, SMOKE), CHANGE_ITEM, False, 20)):
        rows = [tuple(r) for r in landed.collect()]
        got = {r.day: r.ended for r in I.page_cuts(typed_pages(landed, record), stop, cap).collect()}
        assert got == walk_reasons(rows, stop, cap)
