"""Text landings: good rows as landed, damaged lines set aside whole."""

from __future__ import annotations

import pytest

from reelyard.sources.landing import CSV_OUT, land_text
from reelyard.streaming.changes import LANDED_DETAIL_SCHEMA

ROWS = [(1, 200, '{"id": 1, "title": "say \\"hi\\", you\\n"}'), (2, 404, ""), (3, None, None), (4, 200, 'comma, "quote" and back\\slash')]


def test_json_lines(spark, scratch):
    path = scratch("json")
    lines = spark.createDataFrame(ROWS, LANDED_DETAIL_SCHEMA).toJSON().collect()
    bad = [lines[0][:14], '{"id": "five", "status": 200}', "not json", "[1"]
    spark.createDataFrame([(x,) for x in [*lines, *bad, '{"id": 6, "extra": [1]}']], "value string").write.text(path)
    good, rejects = land_text(spark, path, LANDED_DETAIL_SCHEMA, "json")
    assert good.schema == LANDED_DETAIL_SCHEMA
    assert sorted(map(tuple, good.collect())) == [*ROWS, (6, None, None)]
    assert sorted(r.line for r in rejects.collect()) == sorted(bad)
    assert all(r.file.endswith(".txt") for r in rejects.collect())


def test_csv_round_trip_and_rejects(spark, scratch):
    path = scratch("csv")
    frame = spark.createDataFrame(ROWS, LANDED_DETAIL_SCHEMA)
    frame.write.options(**CSV_OUT).csv(path)
    spark.createDataFrame([("x1,200,b",), ("7,2 00,b",), ("8",)], "value string").write.mode("append").text(path)
    good, rejects = land_text(spark, path, LANDED_DETAIL_SCHEMA, "csv")
    assert sorted(map(tuple, good.collect())) == ROWS
    assert {r.line for r in rejects.collect()} == {"x1,200,b", "7,2 00,b", "8"}


def test_empty_landing_and_unknown_kind(spark, scratch):
    path = scratch("none")
    spark.createDataFrame([], "value string").write.text(path)
    for kind in ("json", "csv"):
        good, rejects = land_text(spark, path, LANDED_DETAIL_SCHEMA, kind)
        assert good.collect() == [] == rejects.collect()
    with pytest.raises(ValueError):
        land_text(spark, path, LANDED_DETAIL_SCHEMA, "xml")
