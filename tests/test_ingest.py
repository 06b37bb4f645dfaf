"""Page walks, calendar, look-back and detail typing on hand-made responses."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from reelyard.operators import ingest as I
from reelyard.schemas import CHANGE_ITEM, MOVIE, TV
from reelyard.sources.records import typed_pages
from tests.conftest import plan_text


def landed(spark, rows):
    """rows: (day, page, status, total_pages or None, n_results or None)."""
    out = []
    for day, page, status, total, n in rows:
        body = {"page": page}
        if total is not None:
            body["total_pages"] = total
        if n is not None:
            body["results"] = [{"id": page * 100 + k, "title": "t"} for k in range(n)]
        out.append((day, page, status, json.dumps(body) if status == 200 else '{"e": 1}'))
    return spark.createDataFrame(out, "day string, page int, status int, body string")


def kept(df):
    return sorted((r.day, r.page) for r in df.select("day", "page").collect())


def walk_movies(spark, rows):
    return kept(I.contiguous_pages(typed_pages(landed(spark, rows), MOVIE.schema)))


def test_discover_walk_stops_on_error_empty_last_and_gap(spark):
    rows = [
        ("d1", 1, 200, 5, 1), ("d1", 2, 200, 5, 1), ("d1", 3, 500, None, None), ("d1", 4, 200, 5, 1),
        ("d2", 1, 200, 9, 1), ("d2", 2, 200, 9, 0), ("d2", 3, 200, 9, 1),
        ("d3", 1, 200, 2, 1), ("d3", 2, 200, 2, 1), ("d3", 3, 200, 2, 1),
        ("d4", 1, 200, 9, 1), ("d4", 3, 200, 9, 1),
        ("d5", 1, 200, None, 1), ("d5", 2, 200, None, 1),
        ("d6", 2, 200, 9, 1),
        ("d7", 0, 200, 9, 1), ("d7", 1, 200, 1, 1),
    ]
    assert walk_movies(spark, rows) == [
        ("d1", 1), ("d1", 2), ("d2", 1), ("d3", 1), ("d3", 2), ("d4", 1), ("d5", 1), ("d7", 1)]


def test_change_walk_continues_on_empty_and_caps_pages(spark):
    rows = [("d1", p, 200, 10, 0 if p == 2 else 1) for p in range(1, 8)]
    rows += [("d2", 1, 200, 3, 1), ("d2", 2, 404, None, None), ("d2", 3, 200, 3, 1)]
    pages = typed_pages(landed(spark, rows), CHANGE_ITEM)
    assert kept(I.changed_pages(pages, cap=4)) == [("d1", 1), ("d1", 2), ("d1", 3), ("d1", 4), ("d2", 1)]
    assert len(kept(I.changed_pages(pages, cap=500))) == 8


def test_walk_does_not_shuffle_page_payloads(spark):
    rows = [("d1", p, 200, 3, 1) for p in (1, 2, 3)]
    plan = plan_text(I.contiguous_pages(typed_pages(landed(spark, rows), MOVIE.schema)))
    assert "BroadcastHashJoin" in plan
    payload_side = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in payload_side


def test_flatten_pages_types_records_and_drops_unknown_keys(spark):
    body = json.dumps({"page": 1, "total_pages": 1, "results": [
        {"id": 7, "title": "x", "vote_average": 7.25, "extra": True, "genre_ids": [1, 2]},
        {"id": 8, "vote_average": 6.0},
        {"id": 9, "vote_average": 0}]})
    df = spark.createDataFrame([("d", 1, 200, body)], "day string, page int, status int, body string")
    recs = I.flatten_pages(typed_pages(df, MOVIE.schema), keep=())
    assert recs.columns == MOVIE.columns
    got = {r.id: r for r in recs.collect()}
    assert got[7].vote_average == "7.25" and got[7].genre_ids == [1, 2]
    assert got[8].vote_average == "6.0" and got[8].title is None
    assert got[9].vote_average == "0"


def test_tv_integer_rating_reads_as_double(spark):
    body = json.dumps({"page": 1, "results": [{"id": 1, "name": "n", "vote_average": 7}]})
    df = spark.createDataFrame([("d", 1, 200, body)], "day string, page int, status int, body string")
    recs = I.project_fields(I.flatten_pages(typed_pages(df, TV.schema), keep=()), TV.schema)
    r = recs.collect()[0]
    assert r.vote_average == 7.0 and recs.columns == TV.columns


def test_calendar_covers_leap_years(spark):
    days = I.calendar_for_years(spark, 2020, 2021)
    assert days.count() == 366 + 365
    first, last = days.agg(F.min("day"), F.max("day")).collect()[0]
    assert (first, last) == ("2020-01-01", "2021-12-31")


def test_lookback_excludes_today(spark):
    df = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 11)], "day string")
    got = sorted(r.day for r in I.lookback_days(df, "day", 3, "2024-01-10").collect())
    assert got == ["2024-01-07", "2024-01-08", "2024-01-09"]
    cal = [r.day for r in I.lookback_calendar(spark, 3, "2024-01-10").collect()]
    assert cal == got


def test_details_reshape_defaults_and_failures(spark):
    rows = [
        (1, 200, json.dumps({"id": 1, "title": "a", "vote_average": 8.5,
                             "genres": [{"id": 3, "name": "x"}, {"id": 4, "name": "y"}]})),
        (2, 200, json.dumps({"id": 2, "title": "b"})),
        (3, 404, '{"status_code": 34}'),
        (4, 200, json.dumps({"id": 4, "title": "d", "genres": []})),
    ]
    det = spark.createDataFrame(rows, "id int, status int, body string")
    ids = spark.createDataFrame([(1,), (2,), (3,), (5,)], "id int")
    got = I.enrich_details(ids, det)
    out = {r.id: r for r in I.reshape_details(I.typed_details(got, MOVIE), MOVIE).collect()}
    assert set(out) == {1, 2}
    assert out[1].genre_ids == [3, 4] and out[1].vote_average == "8.5"
    assert out[2].genre_ids == [] and out[2].vote_average == "0.0"


def test_distinct_ids_ignores_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "id int")
    assert sorted(r.id for r in I.distinct_ids(df).collect()) == [1, 2]


def test_decade_of_days(spark):
    df = spark.createDataFrame([("1979-12-31",), ("1980-01-01",), ("2026-06-01",)], "day string")
    assert [r.decade for r in I.backfill_slices(df).collect()] == [1970, 1980, 2020]


def test_fetch_details_runs_the_client_in_tasks(spark):
    def fake_client(ids):
        for i in ids:
            if i % 3 == 0:
                yield i, 404, "{}"
            else:
                yield i, 200, json.dumps({"id": i, "title": f"t{i}", "genres": [{"id": i % 5}]})

    ids = spark.range(1, 31).selectExpr("CAST(id AS INT) AS id")
    landed = I.fetch_details(ids, fake_client, partitions=4)
    assert landed.rdd.getNumPartitions() == 4
    assert landed.count() == 30
    rows = I.reshape_details(I.typed_details(I.enrich_details(ids, landed), MOVIE), MOVIE).collect()
    assert sorted(r.id for r in rows) == [i for i in range(1, 31) if i % 3]
    assert all(r.genre_ids == [r.id % 5] for r in rows)


def test_tv_missing_arrays_are_empty_but_explicit_nulls_stay_null(spark):
    body = json.dumps({"page": 1, "results": [
        {"id": 1, "name": "a"},
        {"id": 2, "name": "b", "genre_ids": None, "origin_country": None},
        {"id": 3, "name": "c", "genre_ids": [4], "origin_country": ["BR"]},
        {"id": 4, "name": "d", "genre_ids": "oops"}]})
    df = spark.createDataFrame([("d", 1, 200, body)], "day string, page int, status int, body string")
    pages = typed_pages(df, TV.schema, TV.record_missing_empty)
    assert pages.schema["results"].dataType.elementType == TV.schema
    got = {r.id: (r.genre_ids, r.origin_country) for r in I.flatten_pages(pages, keep=()).collect()}
    assert got == {1: ([], []), 2: (None, None), 3: ([4], ["BR"]), 4: (None, [])}


def test_tv_detail_missing_origin_country_is_empty(spark):
    rows = [(1, 200, json.dumps({"id": 1, "name": "a"})),
            (2, 200, json.dumps({"id": 2, "name": "b", "origin_country": None,
                                 "vote_average": None})),
            (3, 200, json.dumps({"id": 3, "name": "c", "vote_average": 7}))]
    det = spark.createDataFrame(rows, "id int, status int, body string")
    got = {r.id: (r.origin_country, r.genre_ids, r.vote_average)
           for r in I.reshape_details(I.typed_details(det, TV), TV).collect()}
    assert got == {1: ([], [], 0.0), 2: (None, [], None), 3: ([], [], 7.0)}


def test_movie_detail_rating_missing_vs_null_vs_number(spark):
    rows = [(1, 200, json.dumps({"id": 1, "title": "a"})),
            (2, 200, json.dumps({"id": 2, "title": "b", "vote_average": None})),
            (3, 200, '{"id": 3, "title": "c", "vote_average": 7.50}')]
    det = spark.createDataFrame(rows, "id int, status int, body string")
    got = {r.id: r.vote_average for r in I.reshape_details(I.typed_details(det, MOVIE), MOVIE).collect()}
    assert got == {1: "0.0", 2: None, 3: "7.5"}


def test_lookback_with_literal_today_is_pushed_to_parquet(spark, scratch):
    path = scratch("landed")
    rows = [(f"2024-01-{d:02d}", d) for d in range(1, 31)]
    spark.createDataFrame(rows, "day string, n int").write.parquet(path)
    df = spark.read.parquet(path)
    got = I.lookback_days(df, "day", 3, "2024-01-20")
    assert sorted(r.day for r in got.collect()) == ["2024-01-17", "2024-01-18", "2024-01-19"]
    plan = plan_text(got)
    assert "GreaterThanOrEqual(day,2024-01-17)" in plan and "LessThanOrEqual(day,2024-01-19)" in plan


def test_lookback_on_timestamps_and_dates(spark):
    import datetime as dt

    ts = [dt.datetime(2024, 1, d, 23, 59) for d in (6, 7, 9, 10)]
    df = spark.createDataFrame([(t, t.date()) for t in ts], "ts timestamp, d date")
    assert sorted(r.ts.day for r in I.lookback_days(df, "ts", 3, "2024-01-10").collect()) == [7, 9]
    assert sorted(r.d.day for r in I.lookback_days(df, "d", 3, dt.date(2024, 1, 10)).collect()) == [7, 9]


def test_walk_ends_say_why_each_day_stopped(spark):
    rows = [("a", 1, 200, 2, 1), ("a", 2, 200, 2, 1), ("a", 3, 200, 2, 1),   # reported last page
            ("b", 1, 200, 9, 1), ("b", 2, 500, None, None),                   # failed page
            ("c", 1, 200, 9, 1), ("c", 2, 200, 9, 0),                         # empty page
            ("d", 1, 200, 9, 1), ("d", 3, 200, 9, 1),                         # page 2 never landed
            ("e", 2, 200, 9, 1)]                                              # page 1 never landed
    pages = typed_pages(landed(spark, rows), MOVIE.schema)
    got = {r.day: (r.cut, r.ended) for r in I.page_cuts(pages, True, None).collect()}
    assert got == {"a": (3, "last_page"), "b": (2, "failed_page"), "c": (2, "empty_page"),
                   "d": (2, "missing_page"), "e": (1, "missing_page")}
    ends = {r.ended: r.days for r in I.walk_ends(I.page_cuts(pages, True, None)).collect()}
    assert ends == {"last_page": 1, "failed_page": 1, "empty_page": 1, "missing_page": 2}


def test_fetch_details_tolerates_missing_status(spark):
    def client(ids):
        for i in ids:
            yield i, (None if i == 2 else 200), json.dumps({"id": i, "title": "t"})

    ids = spark.range(1, 4).selectExpr("CAST(id AS INT) AS id")
    got = sorted((r.id, r.status) for r in I.fetch_details(ids, client, partitions=2).collect())
    assert got == [(1, 200), (2, None), (3, 200)]
    kept = I.enrich_details(ids, I.fetch_details(ids, client, partitions=2))
    assert sorted(r.id for r in kept.collect()) == [1, 3]


def test_fetch_details_isolates_a_failing_id(spark):
    def client(ids):
        if 5 in ids:
            raise ConnectionError("reset by peer")
        return [(i, 200, json.dumps({"id": i, "title": "t"})) for i in ids]

    ids = spark.range(1, 9).selectExpr("CAST(id AS INT) AS id")
    landed = I.fetch_details(ids, client, partitions=2)
    assert sorted((r.id, r.status) for r in landed.collect()) == \
        [(i, None if i == 5 else 200) for i in range(1, 9)]
    assert sorted(r.id for r in I.enrich_details(ids, landed).collect()) == [1, 2, 3, 4, 6, 7, 8]
