"""The catalogue pipelines (P1-P7), one parameterised function per pipeline.

Each pipeline is one lazily composed plan ending in one write job; the quality
metrics the reference computes with 8-16 separate actions are gathered with
``observe`` while that job runs.  Media type is a value (``MOVIE``/``TV``),
never a copy of the code.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelyard.functions.joins import DEFAULT_BROADCAST_BYTES, Stored
from reelyard.operators.clean import clean, dedupe_by_id
from reelyard.operators.ingest import (
    backfill_slices,
    calendar_for_years,
    changed_pages,
    contiguous_pages,
    days_not_landed,
    decade_of,
    distinct_ids,
    flatten_pages,
    judged_details,
    lookback_calendar,
    lookback_days,
    reshape_details,
    stored_page_cuts,
    stored_pages,
    walk_ends,
    wanted_details,
)
from reelyard.operators.merge import anti_join, latest_changes, union_by_name
from reelyard.operators.profile import null_count_columns
from reelyard.schemas import CHANGE_ITEM, CHANGE_PAGE_CAP, MediaSpec
from reelyard.sinks.snapshot import (
    current_version,
    read_dataset,
    read_snapshot,
    sink_if_nonempty,
    write_snapshot,
)
from reelyard.sinks.write import path_exists, sink_bronze
from reelyard.sources.records import typed_pages, typed_records_empty
from reelyard.sources.scan import scan_glob

log = logging.getLogger(__name__)


@dataclass
class RunReport:
    """What a pipeline run did; the reference logs the same numbers."""

    rows_written: int = 0
    version: int | None = None
    metrics: dict = field(default_factory=dict)


def _observed(df: DataFrame, name: str, columns: list[str] | None = None
              ) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    exprs: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if columns:
        exprs += [e.alias(f"null_{c}") for e, c in zip(null_count_columns(columns), columns)]
    return df.observe(obs, *exprs), obs


# ---------------------------------------------------------------- P1 / P2

def _ends(cuts: Stored) -> dict:
    """Days per walk end, from the stored cut table (a row for each kind of end)."""
    return {r["ended"]: r["days"] for r in walk_ends(cuts.df).collect()}


def backfill_records(typed: DataFrame, spec: MediaSpec, cuts: Stored | None = None) -> DataFrame:
    """Typed discover pages (stored: they are read twice) -> catalogue records
    tagged by decade."""
    records = flatten_pages(contiguous_pages(typed, cuts=cuts), keep=("day",))
    return backfill_slices(records, "day").select(*spec.columns, "decade")


def backfill(landed_pages: DataFrame, spec: MediaSpec, bronze_root: str,
             dataset: str | None = None, years: tuple[int, int] | None = None) -> RunReport:
    """P1 (movies) / P2 (TV): one job writes every decade slice.

    The bodies are parsed once, into a table of typed pages; the cuts, the walk
    and the records read that.  Dynamic partition overwrite replaces only the
    decades present in this run, so a rerun of one decade leaves the others
    untouched.  Which decades the write filled is observed during it; a decade
    with landed pages but no record becomes a slice with the schema and no rows,
    and so does a decade of ``years`` that has no slice yet, so a backfill
    always leaves a table that can be read.  The
    report counts days by how their page walk ended, so days cut short by a
    failed or missing page are visible (the reference keeps them silently).
    With ``years`` it also counts the calendar days of that range with no
    landed page at all.
    """
    spark = landed_pages.sparkSession
    path = f"{bronze_root.rstrip('/')}/{dataset or spec.bronze_prefix + 'backfill'}"
    typed = stored_pages(typed_pages(landed_pages, spec.schema, spec.record_missing_empty))
    cuts = stored_page_cuts(typed, True, None)
    obs = Observation("decades")
    records = backfill_records(typed, spec, cuts).observe(obs, F.collect_set("decade").alias("filled"))
    rows = sink_bronze(records, path, partition_by=("decade",))
    # A row for each kind of end and decade; days that are no dates have none.
    days = cuts.df.groupBy("ended", decade_of("day").alias("decade")).agg(F.count(F.lit(1)).alias("days")).collect()
    filled = set(obs.get["filled"] or ())
    emptied = sorted({r["decade"] for r in days} - {None} - filled)
    for decade in emptied:
        sink_bronze(typed_records_empty(spark, spec.schema), f"{path}/decade={decade}")
    ends: dict[str, int] = {}
    for r in days:
        ends[r["ended"]] = ends.get(r["ended"], 0) + r["days"]
    metrics = {"path": path, "days_by_end": ends, "emptied": [f"decade={d}" for d in emptied]}
    if years is not None:
        for decade in range(years[0] // 10 * 10, years[1] + 1, 10):
            if decade not in filled and not path_exists(spark, f"{path}/decade={decade}"):
                sink_bronze(typed_records_empty(spark, spec.schema), f"{path}/decade={decade}")
        calendar = calendar_for_years(spark, *years)
        metrics["days_not_landed"] = days_not_landed(calendar, cuts.df).count()
    return RunReport(rows_written=rows, metrics=metrics)


# ---------------------------------------------------------------- P3 / P4

def silver_frame(raw: DataFrame, spec: MediaSpec, order: tuple[str, ...] = ()) -> DataFrame:
    """Clean, then one row per id (newest slice wins), in silver order."""
    return dedupe_by_id(clean(raw, spec), "id", order).select(*spec.silver_order)


def build_silver(spark: SparkSession, bronze_root: str, spec: MediaSpec, silver_path: str,
                 files: int | None = None) -> RunReport:
    """P3 (movies) / P4 (TV): glob every bronze slice, clean, dedupe, snapshot.

    A narrow pass lists the ids that occur more than once, then one job filters
    and writes the rows in place.  Of an id in several slices the row whose file
    was written last wins.  The null profiles and row counts of the raw, cleaned and silver rows
    are observed during the write job.
    """
    bronze = scan_glob(spark, bronze_root, spec.bronze_prefix, schema=spec.schema,
                       version_column="_written")
    raw, obs_raw = _observed(bronze, "raw", spec.columns)
    cleaned, obs_clean = _observed(clean(raw, spec), "cleaned")
    out = dedupe_by_id(cleaned, "id", ("_written",), source=clean(bronze, spec))
    out, obs_out = _observed(out.select(*spec.silver_order), "silver", spec.silver_order)
    base = current_version(spark, silver_path)
    version, rows = write_snapshot(out, silver_path, base, files)
    m_raw, m_clean, m_out = obs_raw.get, obs_clean.get, obs_out.get
    metrics = {
        "raw_rows": m_raw["rows"],
        "removed_invalid": m_raw["rows"] - m_clean["rows"],
        "removed_duplicates": m_clean["rows"] - m_out["rows"],
        "raw_nulls": {c: m_raw[f"null_{c}"] for c in spec.columns},
        "silver_nulls": {c: m_out[f"null_{c}"] for c in spec.silver_order},
    }
    log.info("silver %s v%s: %s", spec.name, version, metrics)
    return RunReport(rows_written=rows, version=version, metrics=metrics)


# ---------------------------------------------------------------------- P5

def change_window(change_pages: DataFrame, today: str, days: int) -> DataFrame:
    """The look-back days' change-list pages, typed and stored."""
    return stored_pages(typed_pages(lookback_days(change_pages, "day", days, today), CHANGE_ITEM))


def changed_details(pages: DataFrame, details: DataFrame, spec: MediaSpec, cap: int = CHANGE_PAGE_CAP,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                    cuts: Stored | None = None) -> DataFrame:
    """Change-list walk -> distinct ids -> their detail responses, typed, with
    ``status`` and ``readable`` (failed lookups included)."""
    ids = distinct_ids(flatten_pages(changed_pages(pages, cap, broadcast_bytes, cuts), keep=()))
    return judged_details(wanted_details(ids, details, "id", broadcast_bytes)
                          .withColumn("_status", F.col("status")), spec, keep=("_status",))


def changed_records(change_pages: DataFrame, details: DataFrame, spec: MediaSpec,
                    today: str, days: int, cap: int = CHANGE_PAGE_CAP,
                    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Look-back days -> change-list walk -> distinct ids -> details -> rows."""
    found = changed_details(change_window(change_pages, today, days), details, spec, cap, broadcast_bytes)
    return _records(found, spec)


def _records(found: DataFrame, spec: MediaSpec) -> DataFrame:
    return reshape_details(found.where((F.col("_status") == 200) & F.col("readable")), spec)


def collect_changes(change_pages: DataFrame, details: DataFrame, spec: MediaSpec,
                    today: str, days: int, changes_path: str,
                    cap: int = CHANGE_PAGE_CAP) -> RunReport:
    """P5: write the change set, or leave the previous one when there is none.

    ``today`` is a literal day, so the look-back reaches the scan.  The report
    counts look-back days by how their change-list walk ended (``page_cap``:
    more pages were reported than are read), days with no landed page at all,
    and the changed ids whose lookup failed or whose body cannot be read.
    """
    pages = change_window(change_pages, today, days)
    cuts = stored_page_cuts(pages, False, cap)
    obs = Observation("details")
    failed = F.coalesce(F.col("_status") != 200, F.lit(True))
    found = changed_details(pages, details, spec, cap, cuts=cuts).observe(
        obs, F.count_if(failed).alias("failed_lookups"),
        F.count_if(~failed & ~F.col("readable")).alias("unreadable_details"))
    rows = sink_if_nonempty(_records(found, spec), changes_path)
    metrics = {"path": changes_path, "days_by_end": _ends(cuts), **obs.get}
    calendar = lookback_calendar(change_pages.sparkSession, days, today)
    metrics["days_not_landed"] = days_not_landed(calendar, cuts.df).count()
    return RunReport(rows_written=rows, metrics=metrics)


# ---------------------------------------------------------------------- P6

def merged_frame(silver: DataFrame, changes: DataFrame, spec: MediaSpec,
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, order: tuple = ()
                 ) -> tuple[DataFrame, list[Observation], int]:
    """Upsert with counters observed on each branch (original, kept, change),
    and how many changes there are.

    ``order`` names version columns of ``changes`` (the newest change of an id
    wins); without it the greatest row wins.
    """
    base, obs_base = _observed(clean(silver, spec).select(*spec.silver_order), "original")
    latest, n, size = latest_changes(clean(changes, spec), spec.silver_order, "id", order)
    kept, obs_kept = _observed(anti_join(base, latest, "id", broadcast_bytes, right_bytes=size), "kept")
    latest_rows, obs_change = _observed(latest, "changes")
    merged, obs_out = _observed(union_by_name(kept, latest_rows), "updated", spec.silver_order)
    return merged, [obs_base, obs_kept, obs_change, obs_out], n


def apply_changes_run(spark: SparkSession, silver_path: str, changes_path: str,
                      spec: MediaSpec, files: int | None = None) -> RunReport:
    """Current silver + change set -> next silver version.

    Reads a committed version and writes the next one beside it, so the input
    is never deleted while it is being read (no cache needed, executor loss
    safe); the version is verified before it is committed.
    """
    base_version = current_version(spark, silver_path)
    silver = read_snapshot(spark, silver_path, base_version)
    changes = read_dataset(spark, changes_path)
    merged, (o_base, o_kept, o_change, o_out), _ = merged_frame(silver, changes, spec)
    version, rows = write_snapshot(merged, silver_path, base_version, files)
    metrics = {
        "original_rows": o_base.get["rows"],
        "replaced_rows": o_base.get["rows"] - o_kept.get["rows"],
        "change_rows": o_change.get["rows"],
        "updated_rows": o_out.get["rows"],
        "updated_nulls": {c: o_out.get[f"null_{c}"] for c in spec.silver_order},
    }
    log.info("apply %s v%s -> v%s: %s", spec.name, base_version, version, metrics)
    return RunReport(rows_written=rows, version=version, metrics=metrics)


# ---------------------------------------------------------------------- P7

def collect_then_apply(spark: SparkSession, change_pages: DataFrame, details: DataFrame,
                       spec: MediaSpec, today: str, days: int, changes_path: str,
                       silver_path: str, cap: int = CHANGE_PAGE_CAP) -> RunReport:
    """Collect the change set; apply it only if the collection succeeded.

    With no new rows the previous change set is left in place and applied
    again, which is harmless: the upsert is idempotent.
    """
    collected = collect_changes(change_pages, details, spec, today, days, changes_path, cap)
    if collected.rows_written == 0 and current_version(spark, changes_path) is None:
        log.warning("no change set at %s yet; nothing to apply", changes_path)
        return RunReport(version=current_version(spark, silver_path))
    return apply_changes_run(spark, silver_path, changes_path, spec)
