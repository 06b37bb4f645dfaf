"""One registered query per operator and pipeline of the inventory.

Every query reads the driver's tables (through ``reelyard.fixtures``) and
returns a DataFrame; the ones that exercise sinks write below the shared
scratch root and return what they read back.  Array columns are rendered as
``[a,b]`` text by ``render`` so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, IntegerType, StructField, StructType

from reelyard import fixtures as fx
from reelyard.operators import clean as C
from reelyard.operators import history as H
from reelyard.operators import ingest as I
from reelyard.operators import intervals as R
from reelyard.operators import merge as J
from reelyard.operators import profile as G
from reelyard.operators import report as T
from reelyard.plans import pipelines as P
from reelyard.schemas import (
    CHANGE_ITEM,
    CHANGE_PAGE_CAP,
    MOVIE,
    MOVIE_DETAIL_SCHEMA,
    TV,
    MediaSpec,
)
from reelyard.session import scratch_path
from reelyard.sinks import snapshot as S
from reelyard.sinks import write as W
from reelyard.sources.records import typed_pages, typed_records, typed_records_empty
from reelyard.sources.scan import scan_glob, scan_path

Query = Callable[[SparkSession, str], DataFrame]


def render(df: DataFrame) -> DataFrame:
    """Arrays -> ``[a,null]`` text (a null array stays null)."""
    return df.select(*[
        F.concat(F.lit("["), F.array_join(F.transform(
            f.name, lambda x: F.coalesce(x.cast("string"), F.lit("null"))), ","), F.lit("]")).alias(f.name)
        if isinstance(f.dataType, ArrayType) else F.col(f.name)
        for f in df.schema.fields])


def _n(col: str) -> F.Column:
    """Size of an array column, null when the array is null."""
    return F.when(F.col(col).isNull(), F.lit(None)).otherwise(F.size(col))


# ------------------------------------------------------------------ inputs

def silver_movies(spark: SparkSession, sf: str) -> DataFrame:
    """The clean, de-duplicated movie catalogue of the bronze fixture."""
    return P.silver_frame(fx.bronze_movies(spark, sf), MOVIE, ("slice",))


def silver_tv(spark: SparkSession, sf: str) -> DataFrame:
    return P.silver_frame(fx.bronze_tv(spark, sf), TV, ("slice",))


def _typed_movie_pages(spark, sf):
    return typed_pages(fx.discover_movie_pages(spark, sf), MOVIE.schema)


def _typed_change_pages(spark, sf):
    return I.stored_pages(typed_pages(fx.change_pages(spark, sf), CHANGE_ITEM))


def _genre_ids(details: DataFrame) -> DataFrame:
    """Typed details with the genres' ids in place of the genres."""
    ids = F.transform("genres", lambda g: g["id"])
    return render(details.withColumn("genre_ids", ids).drop("genres"))


def _page_view(df: DataFrame) -> DataFrame:
    return df.select("day", "page", "status", "total_pages", _n("results").alias("n_results"))


def _change_today(spark: SparkSession, sf: str) -> str:
    """The day after the last landed change-list day, as a literal (one value)."""
    last = fx.table(spark, sf, "events").agg(F.date_add(F.to_date(F.max("ts")), 1)).first()[0]
    return last.isoformat()


def _write_slices(spark: SparkSession, bronze: DataFrame, spec: MediaSpec,
                  changes: DataFrame, names: tuple[str, str] = ("slice0", "slice1")) -> str:
    """Land a bronze fixture as slice directories ``<prefix><name>``, the newer
    one later, plus the change set (which the slice glob must not pick up)."""
    root = scratch_path(spark, f"bronze-{spec.name}")
    for k in (0, 1):
        W.sink_bronze(bronze.where(F.col("slice") == k).drop("slice"),
                      f"{root}/{spec.bronze_prefix}{names[k]}")
    W.sink_bronze(changes, f"{root}/{spec.changes_dataset}")
    return root


# --------------------------------------------------------------- S sources

def q_scan_glob(spark, sf):
    root = _write_slices(spark, fx.bronze_movies(spark, sf), MOVIE, fx.movie_changes(spark, sf))
    return render(scan_glob(spark, root, MOVIE.bronze_prefix, slice_column="slice_dir"))


def q_scan_path(spark, sf):
    path = scratch_path(spark, "scan-path")
    W.sink_bronze(fx.bronze_movies(spark, sf), path)
    schema = StructType([*MOVIE.schema.fields, StructField("slice", IntegerType())])
    return render(scan_path(spark, path, schema))


def q_typed_records(spark, sf):
    det = typed_records(fx.movie_details(spark, sf), "body", MOVIE_DETAIL_SCHEMA, keep=("status",))
    return _genre_ids(det)


def q_typed_records_empty(spark, sf):
    failed = fx.discover_movie_pages(spark, sf).where(F.col("status") != 200)
    recs = I.flatten_pages(typed_pages(failed, MOVIE.schema))
    out = recs.unionByName(typed_records_empty(spark, recs.schema))
    return render(out)


# -------------------------------------------------------------- I ingestion

def q_calendar_days(spark, sf):
    years = fx.table(spark, sf, "orders").agg(
        F.year(F.min("o_orderdate")).alias("start_year"),
        F.year(F.max("o_orderdate")).alias("end_year"))
    return I.calendar_days(years)


def q_flatten_pages(spark, sf):
    return render(I.flatten_pages(_typed_movie_pages(spark, sf)))


def q_contiguous_pages(spark, sf):
    return _page_view(I.contiguous_pages(I.stored_pages(_typed_movie_pages(spark, sf))))


def q_changed_pages(spark, sf):
    return _page_view(I.changed_pages(_typed_change_pages(spark, sf)))


def _walk_ends(spark, sf, cap):
    cuts = I.page_cuts(typed_pages(fx.change_pages(spark, sf), CHANGE_ITEM), False, cap)
    return cuts.select("day", (F.col("cut") - 1).cast("long").alias("pages_kept"), "ended")


def q_page_walk_ends(spark, sf):
    return _walk_ends(spark, sf, CHANGE_PAGE_CAP)


# A cap that the landed days exceed at any size of the tables.
LOW_CAP = 20


def q_page_walk_ends_capped(spark, sf):
    return _walk_ends(spark, sf, LOW_CAP)


def q_changed_pages_capped(spark, sf):
    return _page_view(I.changed_pages(_typed_change_pages(spark, sf), LOW_CAP))


def q_calendar_gaps(spark, sf):
    """Days of the landed years with no landed discover page."""
    landed = fx.discover_movie_pages(spark, sf)
    years = landed.agg(F.year(F.min(F.to_date("day"))).alias("start_year"),
                       F.year(F.max(F.to_date("day"))).alias("end_year"))
    return I.days_not_landed(I.calendar_days(years), landed)


def q_page_completeness(spark, sf):
    pages = _typed_change_pages(spark, sf)
    return I.page_completeness(pages, I.changed_pages(pages))


def q_project_fields(spark, sf):
    pages = typed_pages(fx.discover_tv_pages(spark, sf), TV.schema, TV.record_missing_empty)
    return render(I.project_fields(I.flatten_pages(pages), TV.schema))


def q_lookback_days(spark, sf):
    ev = fx.table(spark, sf, "events")
    today = ev.agg(F.max(F.to_date("ts"))).scalar()
    return (I.lookback_days(ev, F.col("ts"), 3, today)
            .select("event_id", F.date_format(F.to_date("ts"), "yyyy-MM-dd").alias("day")))


def _walked_change_ids(spark, sf):
    return I.distinct_ids(I.flatten_pages(I.changed_pages(_typed_change_pages(spark, sf)), keep=()))


def q_distinct_ids(spark, sf):
    return _walked_change_ids(spark, sf)


def q_enrich_details(spark, sf):
    got = I.enrich_details(_walked_change_ids(spark, sf), fx.movie_details(spark, sf))
    det = typed_records(got, "body", MOVIE_DETAIL_SCHEMA, readable="readable")
    return _genre_ids(det.where("readable").drop("readable"))


def q_reshape_details(spark, sf):
    ok = fx.movie_details(spark, sf).where(F.col("status") == 200)
    return render(I.reshape_details(I.typed_details(ok, MOVIE), MOVIE))


def q_reshape_details_tv(spark, sf):
    ok = fx.tv_details(spark, sf).where(F.col("status") == 200)
    return render(I.reshape_details(I.typed_details(ok, TV), TV))


def q_backfill_slices(spark, sf):
    return render(P.backfill_records(I.stored_pages(_typed_movie_pages(spark, sf)), MOVIE))


def q_backfill_emptied_decade(spark, sf):
    """A rerun in which every page of one decade fails empties that decade."""
    pages = fx.discover_movie_pages(spark, sf)
    odd = F.dayofmonth(F.to_date("day")) % 2 == 1
    later = F.date_format(F.add_months(F.to_date("day"), 120), "yyyy-MM-dd")
    root = scratch_path(spark, "backfill-rerun")
    moved = pages.withColumn("moved", odd).withColumn("day", F.when(odd, later).otherwise(F.col("day")))
    P.backfill(moved.drop("moved"), MOVIE, root)
    failed = moved.withColumn("status", F.when(F.col("moved"), 500).otherwise(F.col("status")))
    rep = P.backfill(failed.drop("moved"), MOVIE, root)
    return render(spark.read.parquet(rep.metrics["path"]))


# ------------------------------------------------------------ C projections

def q_require_keys(spark, sf):
    return render(C.require_keys(fx.bronze_movies(spark, sf), MOVIE.required))


def q_require_keys_steps(spark, sf):
    return C.require_keys_steps(fx.bronze_movies(spark, sf), MOVIE.required)


def _tv_named(spark, sf):
    return C.mutual_coalesce(fx.bronze_tv(spark, sf))


def _visible_nan(df: DataFrame) -> DataFrame:
    """Pre-fill TV frames still hold NaN ratings, which no engine compares equal
    to itself: they are shown as -1."""
    return df.withColumn("vote_average", F.nanvl("vote_average", F.lit(-1.0)))


def q_mutual_coalesce(spark, sf):
    return render(_visible_nan(_tv_named(spark, sf)))


def q_tv_valid_rows(spark, sf):
    return render(_visible_nan(C.tv_valid_rows(_tv_named(spark, sf))))


def q_fill_defaults(spark, sf):
    kept = C.require_keys(fx.bronze_movies(spark, sf), MOVIE.required)
    return render(C.fill_defaults(kept, MOVIE.fills))


def q_fill_defaults_tv(spark, sf):
    return render(C.fill_defaults(C.tv_valid_rows(_tv_named(spark, sf)), TV.fills))


def q_empty_arrays(spark, sf):
    return render(C.empty_arrays(fx.bronze_movies(spark, sf), MOVIE.arrays))


def q_row_count(spark, sf):
    return G.row_count(fx.bronze_movies(spark, sf))


# ----------------------------------------------------------- G aggregation

def q_null_profile(spark, sf):
    return G.null_profile(fx.bronze_movies(spark, sf), MOVIE.columns)


def q_null_profile_tv(spark, sf):
    return G.null_profile(fx.bronze_tv(spark, sf), TV.columns)


def q_null_profile_long(spark, sf):
    return G.null_profile_long(fx.bronze_movies(spark, sf), MOVIE.columns)


def q_removed_counts(spark, sf):
    return G.removed_counts(fx.bronze_movies(spark, sf), MOVIE)


def q_removed_counts_tv(spark, sf):
    return G.removed_counts(fx.bronze_tv(spark, sf), TV)


def q_merge_counts(spark, sf):
    silver = silver_movies(spark, sf)
    changes = fx.movie_changes(spark, sf)
    return G.merge_counts(silver, changes, J.apply_changes(silver, changes, MOVIE))


# ------------------------------------------------------- D distinct / sets

def q_dedupe_by_id(spark, sf):
    cleaned = C.clean(fx.bronze_movies(spark, sf), MOVIE)
    return render(C.dedupe_by_id(cleaned, "id", ("slice",)))


def q_dedupe_lineitem(spark, sf):
    return C.dedupe_by_id(fx.table(spark, sf, "lineitem"), "l_orderkey")


def q_union_by_name(spark, sf):
    changes = C.clean(fx.movie_changes(spark, sf), MOVIE)
    return render(J.union_by_name(silver_movies(spark, sf), changes.select(*reversed(changes.columns))))


# ----------------------------------------------------------------- J joins

def q_anti_join(spark, sf):
    changes = C.clean(fx.movie_changes(spark, sf), MOVIE)
    return render(J.anti_join(silver_movies(spark, sf), changes))


def q_anti_join_shuffled(spark, sf):
    """The same join with no broadcast allowed: the plan beyond the size bound."""
    changes = C.clean(fx.movie_changes(spark, sf), MOVIE)
    return render(J.anti_join(silver_movies(spark, sf), changes, broadcast_bytes=0))


def q_upsert(spark, sf):
    return render(J.upsert(silver_movies(spark, sf), fx.movie_changes(spark, sf)))


def q_apply_changes(spark, sf):
    return render(J.apply_changes(silver_movies(spark, sf), fx.movie_changes(spark, sf), MOVIE))


def q_apply_changes_tv(spark, sf):
    return render(J.apply_changes(silver_tv(spark, sf), fx.tv_changes(spark, sf), TV))


# ------------------------------------------------------------------ W sinks

def q_sink_bronze(spark, sf):
    path = scratch_path(spark, "sink-bronze")
    W.sink_bronze(fx.bronze_movies(spark, sf), path)
    return render(spark.read.parquet(path))


def q_sink_silver(spark, sf):
    path = scratch_path(spark, "sink-silver")
    W.sink_silver(silver_movies(spark, sf), path, files=4)
    return render(spark.read.parquet(path))


def q_sink_if_nonempty(spark, sf):
    path = scratch_path(spark, "sink-guarded")
    recs = P.changed_records(fx.change_pages(spark, sf), fx.movie_details(spark, sf), MOVIE,
                             _change_today(spark, sf), 3)
    S.sink_if_nonempty(recs, path)
    return render(S.read_snapshot(spark, path))


def q_snapshot_replace(spark, sf):
    path = scratch_path(spark, "snapshot")
    S.write_snapshot(silver_movies(spark, sf), path, None)
    base = S.current_version(spark, path)
    merged = J.apply_changes(S.read_snapshot(spark, path, base), fx.movie_changes(spark, sf), MOVIE)
    S.write_snapshot(merged, path, base)
    return render(S.read_snapshot(spark, path))


def q_sql_preview(spark, sf):
    from reelyard.sources.scan import register_view

    path = scratch_path(spark, "snapshot-sql")
    S.write_snapshot(silver_movies(spark, sf), path, None)
    view = register_view(S.read_snapshot(spark, path), "movies_silver")
    return render(spark.sql(f"SELECT * FROM {view} ORDER BY id LIMIT 10"))


def q_preview(spark, sf):
    return render(W.preview(silver_movies(spark, sf), 10, ("id",)))


# --------------------------------------------------------------- pipelines

def _backfill(spark, sf, spec, pages_fn):
    root = scratch_path(spark, f"backfill-{spec.name}")
    rep = P.backfill(pages_fn(spark, sf), spec, root)
    return render(spark.read.parquet(rep.metrics["path"]))


def q_pipeline_backfill_movies(spark, sf):
    return _backfill(spark, sf, MOVIE, fx.discover_movie_pages)


def q_pipeline_backfill_tv(spark, sf):
    return _backfill(spark, sf, TV, fx.discover_tv_pages)


def _silver(spark, sf, spec, bronze_fn, changes_fn):
    # The newer slice has the name that sorts first: when it was written decides.
    root = _write_slices(spark, bronze_fn(spark, sf), spec, changes_fn(spark, sf), ("z", "a"))
    path = scratch_path(spark, f"silver-{spec.name}")
    P.build_silver(spark, root, spec, path)
    return render(S.read_snapshot(spark, path))


def q_pipeline_silver_movies(spark, sf):
    return _silver(spark, sf, MOVIE, fx.bronze_movies, fx.movie_changes)


def q_pipeline_silver_tv(spark, sf):
    return _silver(spark, sf, TV, fx.bronze_tv, fx.tv_changes)


def _collect(spark, sf, spec, details_fn):
    path = scratch_path(spark, f"changes-{spec.name}")
    P.collect_changes(fx.change_pages(spark, sf), details_fn(spark, sf), spec,
                      _change_today(spark, sf), spec.lookback_days, path)
    return render(S.read_snapshot(spark, path))


def q_pipeline_collect_changes(spark, sf):
    return _collect(spark, sf, MOVIE, fx.movie_details)


def q_pipeline_collect_changes_tv(spark, sf):
    return _collect(spark, sf, TV, fx.tv_details)


def q_pipeline_apply_changes(spark, sf):
    silver_path = scratch_path(spark, "silver-apply")
    S.write_snapshot(silver_movies(spark, sf), silver_path, None)
    changes_path = scratch_path(spark, "changes-apply")
    W.sink_bronze(fx.movie_changes(spark, sf), changes_path)
    P.apply_changes_run(spark, silver_path, changes_path, MOVIE)
    return render(S.read_snapshot(spark, silver_path))


def _collect_then_apply(spark, sf, spec, silver, details_fn):
    silver_path = scratch_path(spark, f"silver-p7-{spec.name}")
    S.write_snapshot(silver, silver_path, None)
    P.collect_then_apply(spark, fx.change_pages(spark, sf), details_fn(spark, sf), spec,
                         _change_today(spark, sf), spec.lookback_days,
                         scratch_path(spark, f"changes-p7-{spec.name}"), silver_path)
    return render(S.read_snapshot(spark, silver_path))


def q_pipeline_collect_then_apply(spark, sf):
    return _collect_then_apply(spark, sf, MOVIE, silver_movies(spark, sf), fx.movie_details)


def q_pipeline_collect_then_apply_tv(spark, sf):
    return _collect_then_apply(spark, sf, TV, silver_tv(spark, sf), fx.tv_details)


# ---------------------------------------------------------------- streaming

def q_stream_apply_changes(spark, sf):
    from reelyard.streaming.changes import apply_landed_changes

    silver_path = scratch_path(spark, "silver-stream")
    S.write_snapshot(silver_movies(spark, sf), silver_path, None)
    landing = scratch_path(spark, "landing-details")
    W.sink_bronze(fx.movie_details(spark, sf), landing)
    apply_landed_changes(spark, landing, silver_path, MOVIE)
    return render(S.read_snapshot(spark, silver_path))


def q_stream_apply_twice(spark, sf):
    """Two landings, each applied by a run of its own with default arguments."""
    from reelyard.streaming.changes import apply_landed_changes

    silver_path = scratch_path(spark, "silver-stream-twice")
    S.write_snapshot(silver_movies(spark, sf), silver_path, None)
    landing = scratch_path(spark, "landing-twice")
    details = fx.movie_details(spark, sf)
    for part in (0, 1):
        details.where(F.col("id") % 2 == part).write.mode("append").parquet(landing)
        apply_landed_changes(spark, landing, silver_path, MOVIE)
    return render(S.read_snapshot(spark, silver_path))


def q_stream_latest_details(spark, sf):
    """Three fetches per title land in two runs, older ones after newer ones."""
    from reelyard.streaming.latest import apply_latest_fetches

    silver_path, landing = scratch_path(spark, "silver-latest"), scratch_path(spark, "landing-fetches")
    S.write_snapshot(silver_movies(spark, sf), silver_path, None)
    fetches = fx.detail_fetches(spark, sf)
    ckpt = scratch_path(spark, "ckpt-latest")
    for run in (0, 1):
        here = (F.col("id") + F.col("k")) % 2 == run
        fetches.where(here).drop("k").write.mode("append").parquet(landing)
        apply_latest_fetches(spark, landing, silver_path, MOVIE, ckpt)
    return render(S.read_snapshot(spark, silver_path))


def q_stream_window_counts(spark, sf):
    """Changes per day and kind over two runs; a tenth of one day's changes land late."""
    from reelyard.streaming.latest import count_landed_changes

    changes = fx.title_events(spark, sf)
    landing, out, ckpt = (scratch_path(spark, n) for n in ("landing-events", "day-counts", "ckpt-counts"))
    at = F.col("happened_at")
    late = (F.to_date(at) == "2024-01-19") & (F.col("event_id") % 10 == 0)
    first = (at < F.lit("2024-01-20").cast("timestamp")) & ~late
    for here in (first, ~first):
        changes.where(here).write.mode("append").parquet(landing)
        counts = count_landed_changes(spark, landing, changes.schema, "happened_at", ["event_type"], out, ckpt)
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "changes",
                         "least_id", "greatest_id")


# ------------------------------------------------------ versions over time

def _two_versions(spark, sf) -> str:
    path = scratch_path(spark, "two-versions")
    S.write_snapshot(silver_movies(spark, sf), path, None)
    S.write_snapshot(J.apply_changes(S.read_snapshot(spark, path), fx.movie_changes(spark, sf), MOVIE), path, 1)
    return path


def q_snapshot_diff(spark, sf):
    path = _two_versions(spark, sf)
    return H.snapshot_diff(S.read_snapshot(spark, path, 1), S.read_snapshot(spark, path, 2))


def q_snapshot_diff_back(spark, sf):
    """The way back: what the change set inserted is deleted."""
    path = _two_versions(spark, sf)
    return H.snapshot_diff(S.read_snapshot(spark, path, 2), S.read_snapshot(spark, path, 1))


def q_snapshot_replay(spark, sf):
    path = _two_versions(spark, sf)
    old, new = S.read_snapshot(spark, path, 1), S.read_snapshot(spark, path, 2)
    return render(H.replay(old, H.snapshot_delta(old, new)))


def _seconds(df: DataFrame, *columns: str) -> DataFrame:
    """Times as seconds since 1970, which compare across engines and time zones."""
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


def q_validity_intervals(spark, sf):
    states = H.validity_intervals(fx.title_versions(spark, sf), "id", "changed_at", ["title", "rating"])
    return _seconds(states, "valid_from", "valid_to")


def q_as_of_join(spark, sf):
    versions = fx.title_versions(spark, sf).withColumn("version_at", F.col("changed_at"))
    out = H.as_of_join(fx.title_events(spark, sf), versions, "id", "happened_at", "changed_at",
                       ["title", "rating", "version_at"])
    return _seconds(out.drop("event_type"), "happened_at", "version_at")


# ------------------------------------------------------------- day ranges

def _unlanded_ranges(spark, sf):
    years = fx.table(spark, sf, "orders").agg(
        F.year(F.min("o_orderdate")).alias("start_year"), F.year(F.max("o_orderdate")).alias("end_year"))
    calendar = I.calendar_days(years)
    return R.day_ranges(I.days_not_landed(calendar, calendar.where(~fx.unlanded(F.col("day")))))


def _iso(df: DataFrame) -> DataFrame:
    return df.select(*[F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if f.dataType == DateType()
                       else F.col(f.name) for f in df.schema.fields])


def q_unlanded_ranges(spark, sf):
    return _iso(_unlanded_ranges(spark, sf))


def q_windows_unlanded(spark, sf):
    """Fetch windows and the unlanded day ranges that they touch."""
    ranges = _unlanded_ranges(spark, sf)
    return _iso(R.overlap_join(fx.fetch_windows(spark, sf), ranges, ("window_first", "window_last"),
                               ("first_day", "last_day")))


# ---------------------------------------------------------------- reports

def q_walk_end_rollup(spark, sf):
    return T.walk_end_rollup(I.page_cuts(_typed_movie_pages(spark, sf), True, None))


def q_distinct_sketches(spark, sf):
    """Changed ids per day, month and in all: the sketches' estimates against exact counts."""
    pages = _typed_change_pages(spark, sf)
    ids = I.flatten_pages(I.changed_pages(pages), keep=("day",)).select("day", "id")
    stored = scratch_path(spark, "sketches")
    W.sink_bronze(T.distinct_sketches(ids, "id", ["day"]), stored)
    out = []
    for scope, part in (("day", F.col("day")), ("month", F.substring("day", 1, 7)), ("all", F.lit("all"))):
        named = {"scope": F.lit(scope), "slice": part}
        merged = T.merged_distinct(spark.read.parquet(stored).withColumns(named), ["scope", "slice"])
        exact = ids.withColumns(named).groupBy("scope", "slice").agg(F.countDistinct("id").alias("ids"))
        near = F.abs(F.col("estimate") - F.col("ids")) <= F.ceil(3 * T.STANDARD_ERROR * F.col("ids"))
        out.append(merged.join(exact, ["scope", "slice"]).select("scope", "slice", "ids", near.alias("within_bound")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_top_titles(spark, sf):
    records = P.backfill_records(I.stored_pages(_typed_movie_pages(spark, sf)), MOVIE)
    rating = F.col("vote_average").cast("double")
    return (T.top_k(records, ["decade"], [rating.desc_nulls_last(), F.col("id").asc()], 5)
            .select("decade", "rank", "id", "title", "vote_average"))


# ----------------------------------------------------------- text landings

def _text_landing(spark, sf, kind: str) -> tuple[DataFrame, DataFrame]:
    """Landed details as text files in which some lines are damaged."""
    from reelyard.sources.landing import CSV_OUT, land_text
    from reelyard.streaming.changes import LANDED_DETAIL_SCHEMA

    details, bad = fx.movie_details(spark, sf), F.col("id") % 37 == 5
    path = scratch_path(spark, f"landing-{kind}")
    if kind == "json":
        line = F.to_json(F.struct("id", "status", "body"))
        details.select(F.when(bad, F.substring(line, 1, 12)).otherwise(line)).write.text(path)
    else:
        marked = F.when(bad, F.concat(F.lit("no. "), F.col("id"))).otherwise(F.col("id").cast("string"))
        details.withColumn("id", marked).write.options(**CSV_OUT).csv(path)
    return land_text(spark, path, LANDED_DETAIL_SCHEMA, kind)


def q_landing_json(spark, sf):
    good, _ = _text_landing(spark, sf, "json")
    return render(I.reshape_details(I.typed_details(good.where("status = 200"), MOVIE), MOVIE))


def q_landing_csv(spark, sf):
    good, _ = _text_landing(spark, sf, "csv")
    return render(I.reshape_details(I.typed_details(good.where("status = 200"), MOVIE), MOVIE))


def q_landing_rejects(spark, sf):
    both = [_text_landing(spark, sf, kind)[1].select(F.lit(kind).alias("kind"), "line") for kind in ("json", "csv")]
    lines = both[0].unionByName(both[1])
    return lines.groupBy("kind").agg(F.count(F.lit(1)).alias("rejects"), F.min(F.length("line") > 0).alias("kept_whole"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
