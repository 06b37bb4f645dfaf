"""Property tests: set-oriented operators equal sequential models on random input."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from reelyard.operators import ingest as I
from reelyard.operators import merge as J
from reelyard.schemas import CHANGE_ITEM, MOVIE, MOVIE_SCHEMA
from reelyard.sources.records import typed_pages
from tests.test_walk_bruteforce import walk, walk_reasons

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

page = st.tuples(
    st.integers(1, 9),                          # page number (gaps and repeats of days)
    st.sampled_from([200, 200, 200, 200, 500]),  # status
    st.one_of(st.none(), st.integers(0, 9)),    # total_pages (missing allowed)
    st.integers(0, 2),                          # results on the page
)
day = st.lists(page, min_size=1, max_size=9, unique_by=lambda p: p[0])
days = st.lists(day, min_size=1, max_size=25)


def landed_rows(ds):
    rows = []
    for d, pages in enumerate(ds):
        for p, status, total, n in pages:
            body = {"page": p, "results": [{"id": p * 10 + k} for k in range(n)]}
            if total is not None:
                body["total_pages"] = total
            rows.append((f"d{d:03d}", p, status, json.dumps(body) if status == 200 else "{}"))
    return rows


@SETTINGS
@given(ds=days, cap=st.sampled_from([None, 3, 500]), stop_on_empty=st.booleans())
def test_walk_equals_sequential_walk(spark, ds, cap, stop_on_empty):
    rows = landed_rows(ds)
    df = spark.createDataFrame(rows, "day string, page int, status int, body string")
    typed = typed_pages(df, CHANGE_ITEM)
    got = I.walk_pages(typed, stop_on_empty, cap)
    assert {(r.day, r.page) for r in got.collect()} == walk(rows, stop_on_empty, cap)
    ends = {r.day: r.ended for r in I.page_cuts(typed, stop_on_empty, cap).collect()}
    assert ends == walk_reasons(rows, stop_on_empty, cap)


movie = st.tuples(st.integers(0, 30), st.sampled_from(["a", "b", "c", None]),
                  st.sampled_from(["x", None]))


@SETTINGS
@given(base=st.lists(movie, max_size=40, unique_by=lambda m: m[0]),
       changes=st.lists(movie, max_size=20))
def test_upsert_equals_dict_model(spark, base, changes):
    def frame(rows):
        return spark.createDataFrame([(i, t, o, None, None, None) for i, t, o in rows], MOVIE_SCHEMA)

    out = J.apply_changes(frame(base), frame(changes), MOVIE).collect()
    model = {i: (t, o or "Sem informação.") for i, t, o in base if t is not None}
    latest = {}
    for i, t, o in changes:
        if t is None:
            continue
        cand = (t, o or "Sem informação.")
        latest[i] = max(latest.get(i, cand), cand)  # greatest row wins among duplicates
    model.update(latest)
    assert sorted((r.id, r.title, r.overview) for r in out) == \
        sorted((i, t, o) for i, (t, o) in model.items())
    assert len({r.id for r in out}) == len(out)


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 15)),
                               st.sampled_from(["a", "b", "c"]), st.integers(0, 2)),
                     max_size=60))
def test_dedupe_equals_a_dict_model(spark, rows):
    from pyspark.sql.types import IntegerType, StructField, StructType

    from reelyard.operators.clean import dedupe_by_id

    schema = StructType([*MOVIE_SCHEMA.fields, StructField("v", IntegerType())])
    df = spark.createDataFrame([(i, t, None, None, None, None, v) for i, t, v in rows], schema)
    model = {}
    for i, t, v in rows:
        model[i] = max(model.get(i, (v, t)), (v, t))
    got = {r.id: (r.v, r.title) for r in dedupe_by_id(df, "id", ("v",)).collect()}
    assert got == model
