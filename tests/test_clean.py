"""Cleaning, profiling and de-duplication on hand-made edge rows."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StructField, StructType

from reelyard.operators import clean as C
from reelyard.operators import profile as G
from reelyard.schemas import MOVIE, MOVIE_SCHEMA, OVERVIEW_FILL, TV, TV_SCHEMA
from tests.conftest import plan_text


def movies(spark, rows):
    return spark.createDataFrame(rows, MOVIE_SCHEMA)


def tv(spark, rows):
    return spark.createDataFrame(rows, TV_SCHEMA)


def test_empty_string_is_a_value_not_null(spark):
    df = movies(spark, [(1, "", "", None, None, None), (2, None, "x", None, None, None)])
    out = C.clean(df, MOVIE).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.id, r.title, r.overview) == (1, "", "")
    assert (r.release_date, r.vote_average, r.genre_ids) == ("1900-01-01", "0.0", [])


def test_null_check_is_on_the_array_not_its_elements(spark):
    df = movies(spark, [(1, "t", None, None, None, [1, None]), (2, "t", None, None, None, None)])
    got = {r.id: r.genre_ids for r in C.empty_arrays(df, MOVIE.arrays).collect()}
    assert got == {1: [1, None], 2: []}


def test_tv_fill_replaces_nan_and_null_rating(spark):
    rows = [([1], 1, ["US"], None, "o", None, None, "n", float("nan")),
            ([1], 2, None, "fr", "o", "x", "2020-01-01", "n", None),
            (None, 3, ["BR"], "pt", "o", "x", "2020-01-01", "n", 7.5)]
    got = {r.id: r for r in C.clean(tv(spark, rows), TV).collect()}
    assert got[1].vote_average == 0.0 and got[2].vote_average == 0.0
    assert got[3].vote_average == 7.5
    assert got[1].original_language == "en" and got[1].overview == OVERVIEW_FILL
    assert got[2].origin_country == [] and got[3].genre_ids == []


def test_fill_of_unknown_column_raises(spark):
    df = movies(spark, [(1, "t", None, None, None, None)])
    with pytest.raises(AnalysisException):
        C.fill_defaults(df, {"no_such_column": "x"}).collect()


def test_mutual_coalesce_reads_original_values(spark):
    rows = [([], 1, [], "en", "orig", "x", "d", None, 1.0),
            ([], 2, [], "en", None, "x", "d", "nm", 1.0),
            ([], 3, [], "en", None, "x", "d", None, 1.0)]
    out = C.mutual_coalesce(tv(spark, rows), order=TV.silver_order)
    assert out.columns == TV.silver_order
    got = {r.id: (r.name, r.original_name) for r in out.collect()}
    assert got == {1: ("orig", "orig"), 2: ("nm", "nm"), 3: (None, None)}
    valid = {r.id for r in C.tv_valid_rows(out).collect()}
    assert valid == {1, 2}


def test_tv_silver_column_order(spark):
    df = tv(spark, [([1], 1, ["US"], "en", "o", "x", "2020-01-01", "n", 1.0)])
    assert C.clean(df, TV).columns == TV.silver_order


def test_null_profile_on_empty_input_is_zero(spark):
    prof = G.null_profile(movies(spark, [])).collect()[0]
    assert all(prof[c] == 0 for c in MOVIE.columns)
    long = {r.column_name: r.null_count for r in G.null_profile_long(movies(spark, [])).collect()}
    assert long == {c: 0 for c in MOVIE.columns}


def test_require_keys_steps_counts_each_rule(spark):
    df = movies(spark, [(None, "a", None, None, None, None), (None, None, None, None, None, None),
                        (3, None, None, None, None, None), (4, "t", None, None, None, None)])
    r = C.require_keys_steps(df).collect()[0]
    assert (r.input_rows, r.removed_id, r.removed_title, r.kept_rows) == (4, 2, 1, 1)


def test_dedupe_newest_slice_wins_then_greatest_row(spark):
    rows = [(1, "old", None, None, None, None, 0), (1, "new", None, None, None, None, 1),
            (2, "a", None, None, None, None, 0), (2, "b", None, None, None, None, 0),
            (3, None, None, None, None, None, 0), (3, "x", None, None, None, None, 0)]
    df = spark.createDataFrame(rows, StructType([*MOVIE_SCHEMA.fields, StructField("slice", IntegerType())]))
    got = {r.id: (r.title, r.slice) for r in C.dedupe_by_id(df, "id", ("slice",)).collect()}
    assert got == {1: ("new", 1), 2: ("b", 0), 3: ("x", 0)}


def test_dedupe_is_deterministic_across_partitionings(spark):
    rows = [(i % 50, f"t{i}", None, None, str(i), None) for i in range(2000)]
    a = C.dedupe_by_id(movies(spark, rows).repartition(7)).orderBy("id").collect()
    b = C.dedupe_by_id(movies(spark, rows).repartition(3)).orderBy("id").collect()
    assert a == b and len(a) == 50


def test_dedupe_hot_key_collapses_before_shuffle(spark):
    """A key holding most rows is reduced map-side (partial aggregate)."""
    rows = [(1, f"t{i:05d}", None, None, None, None) for i in range(5000)] + [(2, "z", None, None, None, None)]
    df = C.dedupe_by_id(movies(spark, rows).repartition(8))
    plan = plan_text(df)
    assert "partial_max" in plan
    got = {r.id: r.title for r in df.collect()}
    assert got == {1: "t04999", 2: "z"}


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_dedupe_with_versions_finds_winners_on_narrow_rows(spark, limit):
    """A hot key, ties in the version, null keys and versions; whole rows are not sorted."""
    draw = random.Random(1)
    rows = [(draw.choice([1, 1, 1, None, *range(2, 60)]), f"t{draw.randrange(5)}", None, None, str(i % 3), [i % 4], draw.choice([None, 0, 1, 2])) for i in range(600)]
    rows += rows[:5]
    schema = StructType([*MOVIE_SCHEMA.fields, StructField("slice", IntegerType())])
    df = spark.createDataFrame(rows, schema).repartition(4)
    low = lambda r: [(x is not None, x) for x in (r[6], *r[1:6])]
    best = {}
    for r in rows:
        best[r[0]] = max(best.get(r[0], r), r, key=low)
    got = C.dedupe_by_id(df, "id", ("slice",), broadcast_bytes=limit)
    assert got.columns == df.columns and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, best.values()))
    one = spark.createDataFrame([(1, "a", None, None, None, None, 0), (1, "b", None, None, None, None, 1), (2, "c", None, None, None, None, 0)], schema)
    plan = plan_text(C.dedupe_by_id(one, "id", ("slice",), broadcast_bytes=limit), "simple")
    assert "Sort" not in plan.replace("SortMerge", "Sort") and "Aggregate" not in plan
    assert C.dedupe_by_id(one.limit(0), "id", ("slice",)).collect() == []


def test_removed_counts(spark):
    rows = [(1, "a", None, None, None, None), (1, "b", None, None, None, None),
            (None, "c", None, None, None, None), (2, None, None, None, None, None)]
    r = G.removed_counts(movies(spark, rows), MOVIE).collect()[0]
    assert (r.input_rows, r.removed_invalid, r.removed_duplicates, r.output_rows) == (4, 2, 1, 1)


def test_nan_in_rating_is_not_null_in_profile(spark):
    df = tv(spark, [([1], 1, ["US"], "en", "o", "x", "d", "n", float("nan"))])
    assert G.null_profile(df).collect()[0]["vote_average"] == 0
    assert math.isnan(df.collect()[0].vote_average)
