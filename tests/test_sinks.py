"""Sinks: snapshots, guarded writes, partitioned backfill, globbed scans."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from reelyard.plans import pipelines as P
from reelyard.schemas import MOVIE, MOVIE_SCHEMA
from reelyard.sinks import snapshot as S
from reelyard.sinks import write as W
from reelyard.sources.scan import scan_glob


def movies(spark, rows):
    return spark.createDataFrame(rows, MOVIE_SCHEMA)


ROWS = [(1, "a", "o", "d", "1.0", [1]), (2, "b", "o", "d", "2.0", [])]


def test_snapshot_versions(spark, scratch):
    path = scratch("snap")
    assert S.current_version(spark, path) is None
    assert S.write_snapshot(movies(spark, ROWS), path, None) == (1, 2)
    v1 = S.read_snapshot(spark, path)
    assert S.write_snapshot(v1.where("id = 1"), path, 1) == (2, 1)
    assert S.read_snapshot(spark, path).count() == 1
    assert S.read_snapshot(spark, path, 1).count() == 2
    assert S.versions(spark, path) == [1, 2]


def test_stale_base_is_refused(spark, scratch):
    path = scratch("snap")
    S.write_snapshot(movies(spark, ROWS), path, None)
    S.write_snapshot(movies(spark, ROWS), path, 1)
    with pytest.raises(S.StaleBase):
        S.write_snapshot(movies(spark, ROWS), path, 1)
    assert S.current_version(spark, path) == 2


def test_failed_write_leaves_previous_version_readable(spark, scratch):
    path = scratch("snap")
    S.write_snapshot(movies(spark, ROWS), path, None)
    boom = movies(spark, ROWS).withColumn(
        "title", F.when(F.col("id") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("title")))
    with pytest.raises(Exception):
        S.write_snapshot(boom, path, 1)
    assert S.current_version(spark, path) == 1
    assert S.read_snapshot(spark, path).count() == 2


def test_merge_pipeline_reads_and_replaces_without_losing_input(spark, scratch):
    silver, changes = scratch("silver"), scratch("changes")
    S.write_snapshot(movies(spark, ROWS), silver, None)
    W.sink_bronze(movies(spark, [(2, "b2", None, None, None, None), (3, "c", None, None, None, None)]),
                  changes)
    rep = P.apply_changes_run(spark, silver, changes, MOVIE)
    assert rep.version == 2 and rep.rows_written == 3
    assert rep.metrics["original_rows"] == 2 and rep.metrics["change_rows"] == 2
    assert rep.metrics["replaced_rows"] == 1
    assert all(v == 0 for v in rep.metrics["updated_nulls"].values())
    again = P.apply_changes_run(spark, silver, changes, MOVIE)
    assert sorted(S.read_snapshot(spark, silver, 2).collect()) == \
        sorted(S.read_snapshot(spark, silver, again.version).collect())


def test_sink_if_nonempty_keeps_old_data(spark, scratch):
    path = scratch("changes")
    assert S.sink_if_nonempty(movies(spark, ROWS), path) == 2
    assert S.sink_if_nonempty(movies(spark, ROWS).where("id < 0"), path) == 0
    assert S.read_snapshot(spark, path).count() == 2


def test_sink_silver_fixed_file_count(spark, scratch):
    path = scratch("silver")
    rows = [(i, "t", "o", "d", "1", []) for i in range(100)]
    assert W.sink_silver(movies(spark, rows), path, files=4) == 100
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 4


def test_partitioned_backfill_replaces_only_present_decades(spark, scratch):
    path = scratch("backfill")
    df = spark.createDataFrame([(1, 1970), (2, 1980)], "id int, decade int")
    W.sink_bronze(df, path, partition_by=("decade",))
    W.sink_bronze(spark.createDataFrame([(3, 1980)], "id int, decade int"), path, partition_by=("decade",))
    got = sorted((r.id, r.decade) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1970), (3, 1980)]


def test_glob_scan_skips_change_dataset_and_names_slices(spark, scratch):
    root = scratch("bronze")
    W.sink_bronze(movies(spark, ROWS[:1]), f"{root}/movie_1970")
    W.sink_bronze(movies(spark, ROWS[1:]), f"{root}/movie_1980")
    W.sink_bronze(movies(spark, [(9, "x", None, None, None, None)]), f"{root}/movies_changes")
    got = sorted((r.id, r.s) for r in scan_glob(spark, root, "movie_", slice_column="s").collect())
    assert got == [(1, "movie_1970"), (2, "movie_1980")]


def test_silver_pipeline_metrics(spark, scratch):
    root = scratch("bronze")
    W.sink_bronze(movies(spark, [(1, "old", None, None, None, None), (None, "x", None, None, None, None),
                                 (3, "c", None, None, None, None)]),
                  f"{root}/movie_a")
    W.sink_bronze(movies(spark, [(1, "new", None, None, None, None), (2, None, None, None, None, None)]),
                  f"{root}/movie_b")
    silver = scratch("silver")
    rep = P.build_silver(spark, root, MOVIE, silver)
    assert rep.rows_written == 2 and rep.version == 1
    m = rep.metrics
    assert (m["raw_rows"], m["removed_invalid"], m["removed_duplicates"]) == (5, 2, 1)
    assert m["raw_nulls"]["id"] == 1 and m["raw_nulls"]["title"] == 1
    assert all(v == 0 for v in m["silver_nulls"].values())
    assert {(r.id, r.title) for r in S.read_snapshot(spark, silver).collect()} == {(1, "new"), (3, "c")}


def test_glob_scan_mixes_plain_and_partitioned_slices(spark, scratch):
    root = scratch("bronze")
    W.sink_bronze(movies(spark, ROWS[:1]), f"{root}/movie_legacy")
    part = movies(spark, [(1, "newer", None, None, None, None), (3, "c", None, None, None, None)])
    W.sink_bronze(part.withColumn("decade", F.lit(1990)), f"{root}/movie_backfill",
                  partition_by=("decade",))
    got = sorted((r.id, r.s) for r in scan_glob(spark, root, "movie_", slice_column="s").collect())
    assert got == [(1, "movie_backfill/decade=1990"), (1, "movie_legacy"),
                   (3, "movie_backfill/decade=1990")]
    rep = P.build_silver(spark, root, MOVIE, scratch("silver"))
    assert rep.rows_written == 2


def test_collect_then_apply_with_nothing_collected_leaves_silver(spark, scratch):
    silver = scratch("silver")
    S.write_snapshot(movies(spark, ROWS), silver, None)
    no_pages = spark.createDataFrame([], "day string, page int, status int, body string")
    no_details = spark.createDataFrame([], "id int, status int, body string")
    rep = P.collect_then_apply(spark, no_pages, no_details, MOVIE, "2024-01-10", 3,
                               scratch("changes"), silver)
    assert rep.version == 1 and S.current_version(spark, silver) == 1


def test_a_slice_written_later_wins_whatever_its_name(spark, scratch):
    import time

    root = scratch("bronze")
    W.sink_bronze(movies(spark, [(1, "old", None, None, None, None)]), f"{root}/movie_z")
    time.sleep(0.05)
    W.sink_bronze(movies(spark, [(1, "new", None, None, None, None)]), f"{root}/movie_a")
    silver = scratch("silver")
    P.build_silver(spark, root, MOVIE, silver)
    assert [r.title for r in S.read_snapshot(spark, silver).collect()] == ["new"]


def test_empty_backfill_then_silver(spark, scratch):
    root = scratch("bronze")
    no_pages = spark.createDataFrame([], "day string, page int, status int, body string")
    assert P.backfill(no_pages, MOVIE, root).rows_written == 0
    silver = scratch("silver")
    rep = P.build_silver(spark, root, MOVIE, silver)
    assert rep.rows_written == 0 and rep.version == 1 and rep.metrics["raw_rows"] == 0
    assert S.read_snapshot(spark, silver).columns == MOVIE.columns
    W.sink_bronze(movies(spark, ROWS), f"{root}/movie_more")
    assert P.build_silver(spark, root, MOVIE, silver).rows_written == 2


def test_vacuum_keeps_newest_versions(spark, scratch):
    path = scratch("snap")
    S.write_snapshot(movies(spark, ROWS), path, None)
    for base in (1, 2, 3):
        S.write_snapshot(S.read_snapshot(spark, path), path, base)
    assert S.drop_old_versions(spark, path, keep=2) == [1, 2]
    assert S.read_snapshot(spark, path).count() == 2
    assert S.read_snapshot(spark, path, 3).count() == 2
    assert not os.path.exists(S.version_path(path, 1))
    assert S.drop_old_versions(spark, path, keep=2) == []
    assert S.versions(spark, path) == [3, 4]
    with pytest.raises(FileNotFoundError):
        S.read_snapshot(spark, path, 1)


def test_merge_with_empty_inputs_reports_metrics(spark, scratch):
    silver, changes = scratch("silver"), scratch("changes")
    S.write_snapshot(movies(spark, []), silver, None)
    W.sink_bronze(movies(spark, ROWS), changes)
    m = P.apply_changes_run(spark, silver, changes, MOVIE).metrics
    assert (m["original_rows"], m["change_rows"], m["updated_rows"]) == (0, 2, 2)
    empty = scratch("empty-changes")
    movies(spark, []).write.parquet(empty)
    m = P.apply_changes_run(spark, silver, empty, MOVIE).metrics
    assert (m["original_rows"], m["change_rows"], m["updated_rows"]) == (2, 0, 2)


def test_backfill_reports_walk_ends_and_days_not_landed(spark, scratch):
    import json as _json

    def page(day, n, total):
        return (day, n, 200, _json.dumps({"page": n, "total_pages": total,
                                           "results": [{"id": n, "title": "t"}]}))
    landed = spark.createDataFrame(
        [page("2020-01-01", 1, 1), page("2020-01-02", 1, 5), ("2020-01-02", 2, 500, "{}")],
        "day string, page int, status int, body string")
    rep = P.backfill(landed, MOVIE, scratch("bronze"), years=(2020, 2020))
    assert rep.rows_written == 2
    assert rep.metrics["days_by_end"] == {"last_page": 1, "failed_page": 1}
    assert rep.metrics["days_not_landed"] == 366 - 2


@pytest.mark.parametrize("step", ["_write_version", "_switch"])
def test_a_crash_before_the_switch_keeps_the_change_set(spark, scratch, monkeypatch, step):
    path = scratch("changes")
    assert S.sink_if_nonempty(movies(spark, ROWS), path) == 2

    def crash(*args):
        if step == "_write_version":  # half a version is on disk
            W.sink_bronze(movies(spark, ROWS[:1]), S.version_path(path, 2))
        raise OSError("lost")

    monkeypatch.setattr(S, step, crash)
    with pytest.raises(OSError):
        S.sink_if_nonempty(movies(spark, [(9, "new", None, None, None, None)]), path)
    assert {r.id for r in S.read_snapshot(spark, path).collect()} == {1, 2}
    monkeypatch.undo()
    assert S.sink_if_nonempty(movies(spark, []), path) == 0  # a run without rows takes nothing away
    assert {r.id for r in S.read_dataset(spark, path).collect()} == {1, 2}
    assert S.sink_if_nonempty(movies(spark, [(9, "new", None, None, None, None)]), path) == 1
    assert {r.id for r in S.read_snapshot(spark, path).collect()} == {9}


def test_rows_lost_between_write_and_read_back_are_noticed(spark, scratch, monkeypatch):
    path = scratch("snap")
    S.write_snapshot(movies(spark, ROWS), path, None)
    monkeypatch.setattr(S, "sink_silver", lambda df, target, *a: W.sink_silver(df.limit(1), target, *a) + 1)
    with pytest.raises(S.SnapshotVerificationError):
        S.write_snapshot(movies(spark, ROWS), path, 1)
    assert S.current_version(spark, path) == 1


def landed(spark, pages):
    import json as _json

    rows = [(day, 1, status, _json.dumps({"page": 1, "total_pages": 1, "results": [{"id": 1, "title": day}]}))
            for day, status in pages]
    return spark.createDataFrame(rows, "day string, page int, status int, body string")


def test_backfill_keeps_decades_however_far_off(spark, scratch):
    days = ["2999-01-01", "2020-01-01", "1860-05-05", "0999-01-01", "1859-12-31"]
    rep = P.backfill(landed(spark, [(d, 200) for d in days]), MOVIE, scratch("bronze"))
    assert rep.rows_written == 5 and rep.metrics["emptied"] == []
    got = {(r.title, r.decade) for r in spark.read.parquet(rep.metrics["path"]).collect()}
    assert got == {(d, int(d[:3]) * 10) for d in days}


def test_a_backfill_without_records_leaves_a_typed_table(spark, scratch):
    root = scratch("bronze")
    rep = P.backfill(landed(spark, [("1975-01-01", 500)]), MOVIE, root)
    assert rep.rows_written == 0 and rep.metrics["emptied"] == ["decade=1970"]
    there = spark.read.parquet(rep.metrics["path"])
    assert there.count() == 0 and there.drop("decade").schema == MOVIE.schema
    rep = P.backfill(landed(spark, []), MOVIE, root, years=(1975, 1991))
    assert spark.read.parquet(f"{rep.metrics['path']}/decade=1990").schema == MOVIE.schema
    P.backfill(landed(spark, [("1985-01-01", 200)]), MOVIE, root)
    rep = P.backfill(landed(spark, []), MOVIE, root, years=(1980, 1989))  # a slice that is there stays
    assert [r.title for r in spark.read.parquet(rep.metrics["path"]).collect()] == ["1985-01-01"]
    silver = scratch("silver")
    assert P.build_silver(spark, root, MOVIE, silver).rows_written == 1


def test_an_emptied_decade_is_replaced(spark, scratch):
    import json as _json

    def page(day, status):
        return (day, 1, status, _json.dumps({"page": 1, "total_pages": 1, "results": [{"id": 1, "title": day}]}))

    root, ddl = scratch("bronze"), "day string, page int, status int, body string"
    rep = P.backfill(spark.createDataFrame([page("1975-01-01", 200), page("1985-01-01", 200)], ddl), MOVIE, root)
    assert rep.metrics["emptied"] == []
    rep = P.backfill(spark.createDataFrame([page("1985-01-01", 500)], ddl), MOVIE, root)
    assert rep.metrics["emptied"] == ["decade=1980"] and rep.rows_written == 0
    assert [r.title for r in spark.read.parquet(rep.metrics["path"]).collect()] == ["1975-01-01"]


def test_bad_details_are_counted_and_leave_the_change_set(spark, scratch):
    import json as _json

    def collect(details):
        pages = spark.createDataFrame([("2024-01-09", 1, 200, _json.dumps(
            {"page": 1, "total_pages": 1, "results": [{"id": 1}, {"id": 2}]}))],
            "day string, page int, status int, body string")
        frame = spark.createDataFrame(details, "id int, status int, body string")
        return P.collect_changes(pages, frame, MOVIE, "2024-01-10", 3, path)

    path = scratch("changes")
    rep = collect([(1, 200, '{"id": 1, "title": "a"}'), (2, 500, "{}")])
    assert rep.rows_written == 1 and rep.metrics["failed_lookups"] == 1
    rep = collect([(1, 200, '{"id": 1, "ti'), (2, 404, "{}")])
    assert rep.rows_written == 0
    assert (rep.metrics["failed_lookups"], rep.metrics["unreadable_details"]) == (1, 1)
    assert [r.title for r in S.read_snapshot(spark, path).collect()] == ["a"]


def test_a_capped_day_is_reported(spark, scratch):
    import json as _json

    pages = [("2024-01-09", n, 200, _json.dumps({"page": n, "total_pages": 9, "results": [{"id": n}]})) for n in range(1, 10)]
    details = [(n, 200, _json.dumps({"id": n, "title": "t"})) for n in range(1, 10)]
    rep = P.collect_changes(spark.createDataFrame(pages, "day string, page int, status int, body string"),
                            spark.createDataFrame(details, "id int, status int, body string"),
                            MOVIE, "2024-01-10", 3, scratch("changes"), cap=5)
    assert rep.rows_written == 5 and rep.metrics["days_by_end"] == {"page_cap": 1}
