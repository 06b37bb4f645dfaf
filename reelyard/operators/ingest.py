"""Ingestion operators (I1-I10) over landed API responses.

The reference walks a calendar, pages and ids in driver-side loops and keeps
every record in driver memory.  Here the landing zone is a table (one row per
fetched page or detail, with its HTTP status and JSON body) and each walk rule
is a set-oriented Spark job: no row passes through the driver and no group of
rows is gathered into one task.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from reelyard.functions.columns import empty_array, iso_day
from reelyard.functions.joins import (
    DEFAULT_BROADCAST_BYTES,
    Stored,
    bounded_broadcast,
    materialize_table,
    store_table,
)
from reelyard.schemas import CHANGE_PAGE_CAP, MediaSpec


# ---------------------------------------------------------------- I1 calendar

def calendar_days(ranges: DataFrame, start_year: str = "start_year",
                  end_year: str = "end_year") -> DataFrame:
    """One row per day of each inclusive year range, as ``day`` ISO strings.

    Each day is its own query range (``gte = lte = day``).  Every range row
    expands in the task that holds it; the output is bounded by 366 rows per
    year of range.
    """
    first = F.make_date(F.col(start_year).cast("int"), F.lit(1), F.lit(1))
    last = F.make_date(F.col(end_year).cast("int"), F.lit(12), F.lit(31))
    days = F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("_d")
    return ranges.select(days).select(iso_day(F.col("_d")).alias("day"))


def calendar_for_years(spark: SparkSession, start_year: int, end_year: int) -> DataFrame:
    ranges = spark.range(1).select(F.lit(start_year).alias("start_year"),
                                   F.lit(end_year).alias("end_year"))
    return calendar_days(ranges)


# ------------------------------------------------------------ I2 page flatten

def flatten_pages(pages: DataFrame, keep: tuple[str, ...] = ("day", "page"),
                  results: str = "results") -> DataFrame:
    """``results[]`` of each page -> one row per record (``inline``).

    Empty or null result arrays produce no rows; ``keep`` columns ride along.
    """
    return pages.select(*keep, F.inline(F.col(results)))


# --------------------------------------------------------- I3/I4 page walks

# Why a day's walk ended (``page_cuts``): the reported last page was read, the
# page cap was reached with more pages reported, a page failed (bad status or a
# body that cannot be read), a page was empty (discover walks), or a page was
# never landed.
WALK_ENDS = ("last_page", "page_cap", "failed_page", "empty_page", "missing_page")


def page_cuts(pages: DataFrame, stop_on_empty: bool, cap: int | None) -> DataFrame:
    """Per day, the first page the walk does *not* keep (``cut``) and why the
    walk ended there (``ended``, one of ``WALK_ENDS``).

    The walk reads pages 1, 2, ... and stops at the first page that failed
    (status other than 200, an unreadable body, or no results when ``stop_on_empty``), after the
    first page that reports it is the last (``page >= total_pages``, missing
    -> 1, capped by ``cap``), or at the first page that was never landed.

    One scan, two aggregates, no window: every landed page emits itself and
    its successor ``page + 1``; grouped by ``(day, page)``, a successor with no
    landed row is a gap.  One partial aggregate per day then takes the first
    failure, the first last page and the first gap (or page 1 if it is
    missing).  A day with a huge number of pages is spread over all tasks
    instead of being sorted in one window partition.
    """
    failed = F.col("status").isNull() | (F.col("status") != 200) | ~F.col("readable")
    empty = F.col("results").isNull() | (F.size(F.col("results")) <= 0)
    if not stop_on_empty:
        empty = F.lit(False)
    total = F.coalesce(F.col("total_pages"), F.lit(1))
    p = F.col("page")
    capped = (p >= cap) & (p < total) if cap is not None else F.lit(False)
    entries = F.array(
        F.struct(p.alias("p"), F.lit(True).alias("landed"), failed.alias("failed"),
                 (~failed & empty).alias("empty"), ((p >= total) | capped).alias("done"),
                 capped.alias("capped")),
        F.struct((p + 1).alias("p"), F.lit(False).alias("landed"), F.lit(False).alias("failed"),
                 F.lit(False).alias("empty"), F.lit(False).alias("done"),
                 F.lit(False).alias("capped")),
    )
    per_page = (pages.where(p >= 1).select("day", F.inline(entries))
                .groupBy("day", "p")
                .agg(*[F.max(c).alias(c) for c in ("landed", "failed", "empty", "done", "capped")]))
    q, ok = F.col("p"), F.col("landed")
    good = ok & ~F.col("failed") & ~F.col("empty")
    stats = per_page.groupBy("day").agg(
        F.min(F.when(ok & F.col("failed"), q)).alias("first_failed"),
        F.min(F.when(ok & F.col("empty"), q)).alias("first_empty"),
        F.min(F.when(good & F.col("done"), q + 1)).alias("after_last"),
        F.min(F.when(good & F.col("capped"), q + 1)).alias("after_cap"),
        F.least(F.min(F.when(~ok, q)), F.when(~F.max(ok & (q == 1)), F.lit(1))).alias("first_missing"),
    )
    cut = F.least("first_failed", "first_empty", "after_last", "first_missing")
    ended = (F.when(F.col("cut") == F.col("after_cap"), "page_cap")
             .when(F.col("cut") == F.col("after_last"), "last_page")
             .when(F.col("cut") == F.col("first_failed"), "failed_page")
             .when(F.col("cut") == F.col("first_empty"), "empty_page")
             .otherwise("missing_page"))
    return stats.withColumn("cut", cut).select("day", "cut", ended.alias("ended"))


def stored_page_cuts(pages: DataFrame, stop_on_empty: bool, cap: int | None) -> Stored:
    """``page_cuts`` computed once into a table under the shared scratch folder,
    with its size (one row per day)."""
    return materialize_table(page_cuts(pages, stop_on_empty, cap), "page-cuts")


def walk_pages(pages: DataFrame, stop_on_empty: bool, cap: int | None,
               broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               cuts: Stored | None = None) -> DataFrame:
    """Keep the pages a sequential page walk would have read.

    Only the narrow ``(day, page, status, total_pages, size)`` projection is
    aggregated; the wide page rows are filtered against the per-day cut with a
    broadcast join (one row per day, size checked), so result payloads are
    never shuffled.  ``cuts`` passes a stored cut table (``stored_page_cuts``)
    that the caller also reports from.  Pass stored pages (``stored_pages``):
    they are read twice, and their bodies should be parsed once.
    """
    cuts = cuts if cuts is not None else stored_page_cuts(pages, stop_on_empty, cap)
    side = cuts.df.select("day", "cut")
    if cuts.bytes <= broadcast_bytes:
        side = F.broadcast(side)
    return (pages.join(side, "day", "inner")
            .where((F.col("page") >= 1) & (F.col("page") < F.col("cut")))
            .drop("cut"))


def stored_pages(typed: DataFrame) -> DataFrame:
    """Typed pages stored once, so that the cuts, the walk and the flattening
    read columns instead of parsing the bodies again."""
    return store_table(typed, "typed-pages")


def days_not_landed(calendar: DataFrame, landed_days: DataFrame) -> DataFrame:
    """Calendar days with no landed page at all (never fetched).

    Both sides hold one row per day (bounded by the calendar), so the anti
    join is small whatever the page volume.
    """
    return calendar.join(landed_days.select("day").distinct(), "day", "left_anti")


def walk_ends(cuts: DataFrame) -> DataFrame:
    """Days per walk end (``ended, days``): how many days stopped early."""
    return cuts.groupBy("ended").agg(F.count(F.lit(1)).alias("days"))


def contiguous_pages(pages: DataFrame, broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                     cuts: Stored | None = None) -> DataFrame:
    """Discover walk (I3): an empty page ends the day, no page cap."""
    return walk_pages(pages, True, None, broadcast_bytes, cuts)


def changed_pages(pages: DataFrame, cap: int = CHANGE_PAGE_CAP,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                  cuts: Stored | None = None) -> DataFrame:
    """Change-list walk (I4): empty pages do not stop it; at most ``cap`` pages."""
    return walk_pages(pages, False, cap, broadcast_bytes, cuts)


def page_completeness(pages: DataFrame, kept: DataFrame) -> DataFrame:
    """Per day: pages landed, pages kept by the walk, pages reported.

    The reference silently keeps partial days; this report makes them visible.
    """
    reported = pages.groupBy("day").agg(
        F.count(F.lit(1)).alias("pages_landed"),
        F.max("total_pages").alias("pages_reported"))
    got = kept.groupBy("day").agg(F.count(F.lit(1)).alias("pages_kept"))
    return (reported.join(got, "day", "left")
            .select("day", "pages_landed",
                    F.coalesce("pages_kept", F.lit(0)).alias("pages_kept"),
                    "pages_reported"))


# ------------------------------------------------------------ I5 projection

def project_fields(records: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the declared fields, in declared order, cast to declared types.

    Absent fields become typed nulls (as a missing JSON key does).
    """
    present = set(records.columns)
    return records.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


# ------------------------------------------------------------- I6 look-back

def lookback_days(df: DataFrame, day: Column | str, days: int,
                  today: Column | str | datetime.date) -> DataFrame:
    """Rows whose day lies in ``[today - days, today - 1]`` (today excluded).

    ``today`` is a parameter (a literal date or a scalar column), never the
    clock, so reruns are reproducible.  With a literal ``today`` and a column
    name, the bounds are literals compared with the raw column (ISO day
    strings sort like dates), so the filter reaches the Parquet scan as
    pushed filters / partition pruning: a run reads only its look-back days of
    an ever-growing landing table.
    """
    if isinstance(day, str) and isinstance(today, (str, datetime.date)):
        t = datetime.date.fromisoformat(today) if isinstance(today, str) else today
        lo, hi = t - datetime.timedelta(days=days), t - datetime.timedelta(days=1)
        kind = df.schema[day].dataType
        if isinstance(kind, StringType):
            return df.where(F.col(day).between(lo.isoformat(), hi.isoformat()))
        if isinstance(kind, DateType):
            return df.where(F.col(day).between(F.lit(lo), F.lit(hi)))
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            # ISO strings cast in the session time zone, as ``to_date`` reads it
            start = F.lit(f"{lo.isoformat()} 00:00:00").cast(kind)
            end = F.lit(f"{t.isoformat()} 00:00:00").cast(kind)
            return df.where((F.col(day) >= start) & (F.col(day) < end))
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    t = F.to_date(F.lit(today)) if isinstance(today, str) else F.to_date(today)
    return df.where(d.between(F.date_sub(t, days), F.date_sub(t, 1)))


def lookback_calendar(spark: SparkSession, days: int, today: str) -> DataFrame:
    """The look-back days themselves, ascending: ``day`` ISO strings."""
    t = F.to_date(F.lit(today))
    seq = F.sequence(F.date_sub(t, days), F.date_sub(t, 1), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(seq).alias("_d")).select(iso_day(F.col("_d")).alias("day"))


# ------------------------------------------------------------- I7 distinct ids

def distinct_ids(items: DataFrame, key: str = "id") -> DataFrame:
    """The distinct non-null ids over all days and pages (hash aggregate)."""
    return items.select(key).where(F.col(key).isNotNull()).distinct()


# ----------------------------------------------------- I8/I9 detail handling

def wanted_details(ids: DataFrame, details: DataFrame, key: str = "id",
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Detail responses of the wanted ids, failed ones included.

    A semi join, so each detail row appears once whatever the id list holds;
    the id list is broadcast when within the bound, else both sides shuffle on
    the key.
    """
    wanted, _ = bounded_broadcast(ids.select(key), broadcast_bytes, materialize=True)
    return details.join(wanted, key, "left_semi")


def enrich_details(ids: DataFrame, details: DataFrame, key: str = "id",
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Successful detail responses of the wanted ids (I8); failed lookups
    (status other than 200) are dropped, and so are unreadable bodies when they
    are typed (``typed_details``)."""
    return wanted_details(ids, details.where(F.col("status") == 200), key, broadcast_bytes)


LANDED_DETAIL_DDL = "id int, status int, body string"


def fetch_details(ids: DataFrame, fetch, partitions: int | None = None, key: str = "id") -> DataFrame:
    """Look ids up in an external service, in parallel, as landed responses.

    ``fetch(list_of_ids) -> iterable of (id, status, body)`` is the caller's
    client (HTTP, a cache, ...).  Ids are spread round-robin over
    ``partitions`` tasks (default: the session's shuffle partitions, sized for
    the input) and handed to it in Arrow batches through
    ``mapInPandas``; the result has the landing-table shape that
    ``enrich_details`` and ``reshape_details`` read, so failures stay visible
    as statuses instead of being dropped on the way.  If the client raises for
    a batch, the batch is bisected and retried, and an id that still raises lands
    with a null status (dropped by ``enrich_details``), as one failed lookup
    drops only that id.  Nothing is collected to the driver.
    """
    import pandas as pd

    partitions = partitions or int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def lookup(ids: list[int]) -> list:
        try:
            return list(fetch(ids))
        except Exception:  # noqa: BLE001 - a client error is one failed lookup
            if len(ids) == 1:
                return [(ids[0], None, None)]
            half = len(ids) // 2  # bisect: a few bad ids cost O(log n) extra calls
            return lookup(ids[:half]) + lookup(ids[half:])

    def run(batches):
        for batch in batches:
            rows = lookup([int(i) for i in batch[key]])
            yield pd.DataFrame(rows, columns=["id", "status", "body"]).astype(
                {"id": "Int32", "status": "Int32"})  # nullable: a client may not know either

    return ids.select(key).repartition(partitions).mapInPandas(run, LANDED_DETAIL_DDL)


def reshape_details(details: DataFrame, spec: MediaSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed detail bodies -> catalogue rows.

    ``genres[].id`` -> ``genre_ids`` (missing -> ``[]``), everything else as
    typed; columns in the catalogue schema order, then the ``keep`` columns.
    The rating default for a missing key is applied when the body is typed
    (``typed_details``), where a missing key and a JSON null are told apart.
    """
    ids = F.transform(F.col("genres"), lambda g: g["id"])
    exprs = {
        "genre_ids": F.coalesce(ids, empty_array(spec.arrays["genre_ids"])).alias("genre_ids"),
    }
    return details.select(*[exprs.get(c, F.col(c).cast(spec.schema[c].dataType).alias(c))
                            for c in spec.columns], *keep)


def typed_details(details: DataFrame, spec: MediaSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed detail bodies typed with the media type's missing-key rules.

    A body that cannot be read, or has no id, is dropped: it is a failed lookup.
    """
    return judged_details(details, spec, keep).where("readable").drop("readable")


def judged_details(details: DataFrame, spec: MediaSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """``typed_details`` with all rows and a last column ``readable`` (JSON with an id)."""
    from reelyard.sources.records import typed_records

    typed = typed_records(details, "body", spec.detail_schema, keep,
                          missing_empty=spec.detail_missing_empty,
                          missing_default=spec.detail_missing_default, readable="readable")
    return typed.withColumn("readable", F.col("readable") & F.col("id").isNotNull())


# -------------------------------------------------------- I10 decade slices

def decade_of(day: Column | str) -> Column:
    """First year of the decade a day falls in (2020-2026 -> 2020)."""
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    return (F.floor(F.year(d) / 10) * 10).cast("int")


def backfill_slices(records: DataFrame, day: str = "day") -> DataFrame:
    """Tag each record with the decade slice of the day it was fetched for.

    Written with ``partitionBy("decade")`` and dynamic partition overwrite,
    each slice is replaced on its own by one job, instead of one job per slice.
    """
    return records.withColumn("decade", decade_of(day))
