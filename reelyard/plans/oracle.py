"""DuckDB SQL for every registered query, over the driver's tables.

Written independently of the Spark plans: the page walks are running-window
formulations (Spark uses per-day aggregates and an anti join), de-duplication
is ``row_number``, anti joins are ``NOT EXISTS``.
"""

from __future__ import annotations

from reelyard.fixtures import with_fixtures
from reelyard.schemas import CHANGE_PAGE_CAP, DATE_FILL, LANGUAGE_FILL, MOVIE_RATING_FILL
from reelyard.schemas import OVERVIEW_FILL as FILL_TEXT


def arr(col: str, alias: str | None = None) -> str:
    items = f"[coalesce(CAST(x AS VARCHAR), 'null') for x in {col}]"
    return f"'[' || array_to_string({items}, ',') || ']' AS {alias or col}"


MOVIE_OUT = f"id, title, overview, release_date, vote_average, {arr('genre_ids')}"
TV_OUT = (f"{arr('genre_ids')}, id, {arr('origin_country')}, original_language, overview, "
          "first_air_date, vote_average, name, original_name")


def walk(src: str, stop_on_empty: bool, cap: int | None) -> str:
    bad = "status <> 200 OR NOT readable" + (" OR coalesce(n_results, 0) = 0" if stop_on_empty else "")
    last = "coalesce(total_pages, 1)" if cap is None else f"least(coalesce(total_pages, 1), {cap})"
    return f"""
SELECT * EXCLUDE (bad_run, done_run, rn) FROM (
  SELECT *,
    sum(CASE WHEN {bad} THEN 1 ELSE 0 END)
      OVER (PARTITION BY day ORDER BY page ROWS UNBOUNDED PRECEDING) AS bad_run,
    coalesce(sum(CASE WHEN page >= {last} THEN 1 ELSE 0 END)
      OVER (PARTITION BY day ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS done_run,
    row_number() OVER (PARTITION BY day ORDER BY page) AS rn
  FROM {src}) WHERE bad_run = 0 AND done_run = 0 AND rn = page"""


CLEAN_MOVIES = f"""
SELECT id, title, coalesce(overview, '{FILL_TEXT}') AS overview,
       coalesce(release_date, '{DATE_FILL}') AS release_date,
       coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average,
       coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids, slice
FROM bronze_movies WHERE id IS NOT NULL AND title IS NOT NULL"""

SILVER_MOVIES = f"""
SELECT id, title, overview, release_date, vote_average, genre_ids FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY slice DESC, title DESC, overview DESC,
                               release_date DESC, vote_average DESC) AS rn
  FROM ({CLEAN_MOVIES})) WHERE rn = 1"""

CLEAN_MOVIE_CHANGES = f"""
SELECT id, title, coalesce(overview, '{FILL_TEXT}') AS overview,
       coalesce(release_date, '{DATE_FILL}') AS release_date,
       coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average,
       coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids
FROM movie_changes WHERE id IS NOT NULL AND title IS NOT NULL"""


def clean_tv(src: str, extra: str = "") -> str:
    return f"""
SELECT coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids, id,
       coalesce(origin_country, CAST([] AS VARCHAR[])) AS origin_country,
       coalesce(original_language, '{LANGUAGE_FILL}') AS original_language,
       coalesce(overview, '{FILL_TEXT}') AS overview,
       coalesce(first_air_date, '{DATE_FILL}') AS first_air_date,
       CASE WHEN vote_average IS NULL OR isnan(vote_average) THEN CAST(0 AS DOUBLE)
            ELSE vote_average END AS vote_average,
       coalesce(name, original_name) AS name, coalesce(original_name, name) AS original_name{extra}
FROM {src} WHERE id IS NOT NULL AND (name IS NOT NULL OR original_name IS NOT NULL)"""


SILVER_TV = f"""
SELECT genre_ids, id, origin_country, original_language, overview, first_air_date,
       vote_average, name, original_name FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY slice DESC) AS rn
  FROM ({clean_tv('bronze_tv', ', slice')})) WHERE rn = 1"""

APPLY_MOVIES = f"""
SELECT * FROM silver_movies s
WHERE NOT EXISTS (SELECT 1 FROM clean_movie_changes c WHERE c.id = s.id)
UNION ALL SELECT * FROM clean_movie_changes"""

DECADE = "CAST(floor(year(CAST(day AS DATE)) / 10) * 10 AS INTEGER) AS decade"

def change_window(days: int) -> str:
    """The last ``days`` landed days (today is the day after the last one)."""
    return f"""
SELECT * FROM change_pages
WHERE CAST(day AS DATE) BETWEEN (SELECT max(CAST(day AS DATE)) FROM change_pages) - {days - 1}
                            AND (SELECT max(CAST(day AS DATE)) FROM change_pages)"""


CHANGE_WINDOW = change_window(3)


def _ids_of(pages: str) -> str:
    return f"""
SELECT DISTINCT CAST(user_id * 7 AS INTEGER) AS id FROM ({pages}) WHERE n_results = 2
UNION SELECT DISTINCT CAST(user_id * 7 + 3 AS INTEGER) FROM ({pages}) WHERE n_results = 2"""


def _collected(pages: str) -> str:
    return f"""
SELECT id, title, overview, release_date, coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average,
       coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids
FROM movie_details WHERE ok AND id IN ({_ids_of(pages)})"""


def _collected_tv(pages: str) -> str:
    return f"""
SELECT coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids, id, origin_country,
       original_language, original_name, overview, first_air_date, name,
       coalesce(vote_average, CAST(0 AS DOUBLE)) AS vote_average
FROM tv_details WHERE ok AND id IN ({_ids_of(pages)})"""


def _q(names: list[str], body: str) -> str:
    return with_fixtures(names, body)


def _with(names: list[str], ctes: dict[str, str], body: str) -> str:
    """Fixtures plus extra named CTEs, then the body."""
    base = with_fixtures(names, "SELECT 1")
    head = base[: base.rindex("SELECT 1")].rstrip()
    extra = "".join(f",\n{n} AS ({sql.strip()})" for n, sql in ctes.items())
    return f"{head}{extra}\n{body.strip()}"


SILVER_CTES = {"silver_movies": SILVER_MOVIES, "clean_movie_changes": CLEAN_MOVIE_CHANGES}
MOVIE_INPUTS = ["bronze_movies", "movie_changes"]

ORACLE: dict[str, str] = {}

# ---------------------------------------------------------------- sources
ORACLE["scan_glob"] = _q(["bronze_movies"], f"""
SELECT {MOVIE_OUT}, 'movie_slice' || CAST(slice AS VARCHAR) AS slice_dir FROM bronze_movies""")
ORACLE["scan_path"] = _q(["bronze_movies"], f"SELECT {MOVIE_OUT}, slice FROM bronze_movies")
ORACLE["typed_records"] = _q(["movie_details"], f"""
SELECT status,
       CASE WHEN ok THEN id END AS id,
       CASE WHEN ok THEN title END AS title,
       CASE WHEN ok THEN overview END AS overview,
       CASE WHEN ok THEN release_date END AS release_date,
       CASE WHEN ok THEN vote_average END AS vote_average,
       {arr("CASE WHEN ok THEN genre_ids END", "genre_ids")}
FROM movie_details""")
ORACLE["typed_records_empty"] = _q(["discover_movie_records"], f"""
SELECT r.day, r.page, {MOVIE_OUT}
FROM discover_movie_records r JOIN discover_pages p ON p.day = r.day AND p.page = r.page
WHERE p.status <> 200""")

# -------------------------------------------------------------- ingestion
ORACLE["calendar_days"] = """
SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS day
FROM (SELECT unnest(generate_series(make_date(CAST(year(min(o_orderdate)) AS BIGINT), 1, 1),
                                    make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31),
                                    INTERVAL 1 DAY)) AS d FROM orders)"""
ORACLE["calendar_gaps"] = _q(["discover_pages"], """
SELECT strftime(CAST(d AS DATE), '%Y-%m-%d') AS day
FROM (SELECT unnest(generate_series(make_date(year(min(CAST(day AS DATE))), 1, 1),
                                    make_date(year(max(CAST(day AS DATE))), 12, 31),
                                    INTERVAL 1 DAY)) AS d FROM discover_pages)
WHERE strftime(CAST(d AS DATE), '%Y-%m-%d') NOT IN (SELECT day FROM discover_pages)""")
ORACLE["flatten_pages"] = _q(["discover_movie_records"], f"SELECT day, page, {MOVIE_OUT} "
                                                         "FROM discover_movie_records")
ORACLE["contiguous_pages"] = _q(["discover_pages"], f"""
SELECT day, page, status, total_pages, n_results FROM ({walk('discover_pages', True, None)})""")
ORACLE["changed_pages"] = _q(["change_pages"], f"""
SELECT day, page, status, total_pages, n_results FROM ({walk('change_pages', False, CHANGE_PAGE_CAP)})""")
ORACLE["page_completeness"] = _q(["change_pages"], f"""
SELECT a.day, a.pages_landed, coalesce(k.pages_kept, 0) AS pages_kept, a.pages_reported
FROM (SELECT day, count(*) AS pages_landed, max(total_pages) AS pages_reported
      FROM change_pages GROUP BY day) a
LEFT JOIN (SELECT day, count(*) AS pages_kept FROM ({walk('change_pages', False, CHANGE_PAGE_CAP)}) GROUP BY day) k
  ON a.day = k.day""")


def _walk_ends(cap: int) -> str:
    return f"""
SELECT d.day, coalesce(k.pages_kept, 0) AS pages_kept,
       CASE WHEN lp.page >= {cap} AND lp.page < coalesce(lp.total_pages, 1) THEN 'page_cap'
            WHEN lp.page >= coalesce(lp.total_pages, 1) THEN 'last_page'
            WHEN np.page IS NOT NULL AND (np.status <> 200 OR NOT np.readable) THEN 'failed_page'
            ELSE 'missing_page' END AS ended
FROM (SELECT DISTINCT day FROM change_pages WHERE page >= 1) d
LEFT JOIN (SELECT day, count(*) AS pages_kept FROM ({walk('change_pages', False, cap)}) GROUP BY day) k
  ON k.day = d.day
LEFT JOIN change_pages lp ON lp.day = d.day AND lp.page = k.pages_kept
LEFT JOIN change_pages np ON np.day = d.day AND np.page = coalesce(k.pages_kept, 0) + 1"""


ORACLE["page_walk_ends"] = _q(["change_pages"], _walk_ends(CHANGE_PAGE_CAP))
# A cap that the landed days exceed at any size of the tables.
LOW_CAP = 20
ORACLE["page_walk_ends_capped"] = _q(["change_pages"], _walk_ends(LOW_CAP))
ORACLE["changed_pages_capped"] = _q(["change_pages"], f"""
SELECT day, page, status, total_pages, n_results FROM ({walk('change_pages', False, LOW_CAP)})""")
ORACLE["project_fields"] = _q(["discover_tv_records"], f"SELECT {TV_OUT} FROM discover_tv_records")
ORACLE["lookback_days"] = """
SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events
WHERE CAST(ts AS DATE) BETWEEN (SELECT max(CAST(ts AS DATE)) FROM events) - 3
                           AND (SELECT max(CAST(ts AS DATE)) FROM events) - 1"""
_WALKED_CHANGES = walk("change_pages", False, CHANGE_PAGE_CAP)
ORACLE["distinct_ids"] = _q(["change_pages"], _ids_of(_WALKED_CHANGES))
ORACLE["enrich_details"] = _q(["change_pages", "movie_details"], f"""
SELECT id, title, overview, release_date, vote_average, {arr("genre_ids")}
FROM movie_details WHERE ok AND id IN ({_ids_of(_WALKED_CHANGES)})""")
ORACLE["reshape_details"] = _q(["movie_details"], f"""
SELECT id, title, overview, release_date, coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average,
       {arr("coalesce(genre_ids, CAST([] AS INTEGER[]))", "genre_ids")}
FROM movie_details WHERE ok""")
ORACLE["reshape_details_tv"] = _q(["tv_details"], f"""
SELECT {arr("coalesce(genre_ids, CAST([] AS INTEGER[]))", "genre_ids")}, id,
       {arr('origin_country')}, original_language, original_name, overview, first_air_date,
       name, coalesce(vote_average, CAST(0 AS DOUBLE)) AS vote_average
FROM tv_details WHERE ok""")
_KEPT_RECORDS = f"""
SELECT r.* FROM discover_movie_records r
JOIN ({walk('discover_pages', True, None)}) k ON k.day = r.day AND k.page = r.page"""
ORACLE["backfill_slices"] = _q(["discover_movie_records"], f"""
SELECT {MOVIE_OUT}, {DECADE} FROM ({_KEPT_RECORDS})""")

# ------------------------------------------------------------ projections
ORACLE["require_keys"] = _q(["bronze_movies"], f"""
SELECT {MOVIE_OUT}, slice FROM bronze_movies WHERE id IS NOT NULL AND title IS NOT NULL""")
ORACLE["require_keys_steps"] = _q(["bronze_movies"], """
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE id IS NULL) AS removed_id,
       count(*) FILTER (WHERE id IS NOT NULL AND title IS NULL) AS removed_title,
       count(*) FILTER (WHERE id IS NOT NULL AND title IS NOT NULL) AS kept_rows
FROM bronze_movies""")
_TV_NAMED = f"""
SELECT {arr('genre_ids')}, id, {arr('origin_country')}, original_language, overview,
       first_air_date, CASE WHEN isnan(vote_average) THEN -1.0 ELSE vote_average END AS vote_average,
       slice, coalesce(name, original_name) AS name, coalesce(original_name, name) AS original_name
FROM bronze_tv"""
ORACLE["mutual_coalesce"] = _q(["bronze_tv"], _TV_NAMED)
ORACLE["tv_valid_rows"] = _q(["bronze_tv"], f"""
SELECT * FROM ({_TV_NAMED}) WHERE id IS NOT NULL AND (name IS NOT NULL OR original_name IS NOT NULL)""")
ORACLE["fill_defaults"] = _q(["bronze_movies"], f"""
SELECT id, title, coalesce(overview, '{FILL_TEXT}') AS overview,
       coalesce(release_date, '{DATE_FILL}') AS release_date,
       coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average, {arr('genre_ids')}, slice
FROM bronze_movies WHERE id IS NOT NULL AND title IS NOT NULL""")
ORACLE["fill_defaults_tv"] = _q(["bronze_tv"], f"""
SELECT {arr('genre_ids')}, id, {arr('origin_country')},
       coalesce(original_language, '{LANGUAGE_FILL}') AS original_language,
       coalesce(overview, '{FILL_TEXT}') AS overview,
       coalesce(first_air_date, '{DATE_FILL}') AS first_air_date,
       CASE WHEN vote_average IS NULL OR isnan(vote_average) THEN CAST(0 AS DOUBLE)
            ELSE vote_average END AS vote_average, slice,
       coalesce(name, original_name) AS name, coalesce(original_name, name) AS original_name
FROM bronze_tv WHERE id IS NOT NULL AND (name IS NOT NULL OR original_name IS NOT NULL)""")
ORACLE["empty_arrays"] = _q(["bronze_movies"], f"""
SELECT id, title, overview, release_date, vote_average,
       {arr("coalesce(genre_ids, CAST([] AS INTEGER[]))", "genre_ids")}, slice
FROM bronze_movies""")
ORACLE["row_count"] = _q(["bronze_movies"], "SELECT count(*) AS row_count FROM bronze_movies")

# ------------------------------------------------------------ aggregation
_MOVIE_COLS = ["id", "title", "overview", "release_date", "vote_average", "genre_ids"]
_TV_COLS = ["genre_ids", "id", "origin_country", "original_language", "original_name",
            "overview", "first_air_date", "name", "vote_average"]


def _nulls(cols: list[str]) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)


ORACLE["null_profile"] = _q(["bronze_movies"], f"SELECT {_nulls(_MOVIE_COLS)} FROM bronze_movies")
ORACLE["null_profile_tv"] = _q(["bronze_tv"], f"SELECT {_nulls(_TV_COLS)} FROM bronze_tv")
ORACLE["null_profile_long"] = _q(["bronze_movies"], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
    f"FROM bronze_movies" for c in _MOVIE_COLS))
ORACLE["removed_counts"] = _q(["bronze_movies"], """
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE id IS NULL OR title IS NULL) AS removed_invalid,
       count(*) FILTER (WHERE id IS NOT NULL AND title IS NOT NULL)
         - count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND title IS NOT NULL)
         AS removed_duplicates,
       count(DISTINCT id) FILTER (WHERE id IS NOT NULL AND title IS NOT NULL) AS output_rows
FROM bronze_movies""")
_TV_OK = "id IS NOT NULL AND (name IS NOT NULL OR original_name IS NOT NULL)"
ORACLE["removed_counts_tv"] = _q(["bronze_tv"], f"""
SELECT count(*) AS input_rows,
       count(*) FILTER (WHERE NOT ({_TV_OK})) AS removed_invalid,
       count(*) FILTER (WHERE {_TV_OK}) - count(DISTINCT id) FILTER (WHERE {_TV_OK})
         AS removed_duplicates,
       count(DISTINCT id) FILTER (WHERE {_TV_OK}) AS output_rows
FROM bronze_tv""")
ORACLE["merge_counts"] = _with(MOVIE_INPUTS, SILVER_CTES, f"""
SELECT (SELECT count(*) FROM silver_movies) AS original_rows,
       (SELECT count(*) FROM movie_changes) AS change_rows,
       (SELECT count(*) FROM ({APPLY_MOVIES})) AS updated_rows""")

# ----------------------------------------------------- distinct and sets
ORACLE["dedupe_by_id"] = _q(["bronze_movies"], f"""
SELECT {MOVIE_OUT}, slice FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY slice DESC, title DESC, overview DESC,
                               release_date DESC, vote_average DESC) AS rn
  FROM ({CLEAN_MOVIES})) WHERE rn = 1""")
ORACLE["dedupe_lineitem"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey DESC, l_suppkey DESC,
      l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
      l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
  FROM lineitem) WHERE rn = 1"""
ORACLE["union_by_name"] = _with(MOVIE_INPUTS, SILVER_CTES, f"""
SELECT {MOVIE_OUT} FROM silver_movies
UNION ALL SELECT {MOVIE_OUT} FROM clean_movie_changes""")

# ------------------------------------------------------------------ joins
ORACLE["anti_join"] = _with(MOVIE_INPUTS, SILVER_CTES, f"""
SELECT {MOVIE_OUT} FROM silver_movies s
WHERE NOT EXISTS (SELECT 1 FROM clean_movie_changes c WHERE c.id = s.id)""")
ORACLE["upsert"] = _with(MOVIE_INPUTS, SILVER_CTES, f"""
SELECT {MOVIE_OUT} FROM silver_movies s
WHERE NOT EXISTS (SELECT 1 FROM movie_changes c WHERE c.id = s.id)
UNION ALL SELECT {MOVIE_OUT} FROM movie_changes""")
ORACLE["apply_changes"] = _with(MOVIE_INPUTS, SILVER_CTES, f"SELECT {MOVIE_OUT} FROM ({APPLY_MOVIES})")
ORACLE["apply_changes_tv"] = _with(["bronze_tv", "tv_changes"], {
    "silver_tv": SILVER_TV, "clean_tv_changes": clean_tv("tv_changes")}, f"""
SELECT {TV_OUT} FROM (
  SELECT * FROM silver_tv s WHERE NOT EXISTS (SELECT 1 FROM clean_tv_changes c WHERE c.id = s.id)
  UNION ALL SELECT * FROM clean_tv_changes)""")

ORACLE["anti_join_shuffled"] = ORACLE["anti_join"]

# ------------------------------------------------------------------ sinks
ORACLE["sink_bronze"] = ORACLE["scan_path"]
ORACLE["sink_silver"] = _with(MOVIE_INPUTS, SILVER_CTES, f"SELECT {MOVIE_OUT} FROM silver_movies")
_COLLECTED = _collected(walk(f"({CHANGE_WINDOW})", False, CHANGE_PAGE_CAP))
ORACLE["sink_if_nonempty"] = _q(["change_pages", "movie_details"],
                                f"SELECT {MOVIE_OUT} FROM ({_COLLECTED})")
ORACLE["snapshot_replace"] = ORACLE["apply_changes"]
ORACLE["sql_preview"] = _with(MOVIE_INPUTS, SILVER_CTES,
                              f"SELECT {MOVIE_OUT} FROM silver_movies ORDER BY id LIMIT 10")
ORACLE["preview"] = _with(MOVIE_INPUTS, SILVER_CTES,
                          f"SELECT {MOVIE_OUT} FROM silver_movies ORDER BY id LIMIT 10")

# -------------------------------------------------------------- pipelines
ORACLE["pipeline_backfill_movies"] = ORACLE["backfill_slices"]
_KEPT_TV = f"""
SELECT r.* FROM discover_tv_records r
JOIN ({walk('discover_pages', True, None)}) k ON k.day = r.day AND k.page = r.page"""
ORACLE["pipeline_backfill_tv"] = _q(["discover_tv_records"], f"""
SELECT {TV_OUT}, {DECADE}
FROM ({_KEPT_TV})""")
ORACLE["pipeline_silver_movies"] = ORACLE["sink_silver"]
ORACLE["pipeline_silver_tv"] = _with(["bronze_tv"], {"silver_tv": SILVER_TV},
                                     f"SELECT {TV_OUT} FROM silver_tv")
ORACLE["pipeline_collect_changes"] = ORACLE["sink_if_nonempty"]
ORACLE["pipeline_apply_changes"] = ORACLE["apply_changes"]
ORACLE["pipeline_collect_then_apply"] = _with(
    ["bronze_movies", "change_pages", "movie_details"],
    {"silver_movies": SILVER_MOVIES, "collected": _COLLECTED}, f"""
SELECT {MOVIE_OUT} FROM (
  SELECT * FROM silver_movies s WHERE NOT EXISTS (SELECT 1 FROM collected c WHERE c.id = s.id)
  UNION ALL SELECT * FROM collected)""")

_COLLECTED_TV = _collected_tv(walk(f"({change_window(10)})", False, CHANGE_PAGE_CAP))
ORACLE["pipeline_collect_changes_tv"] = _q(["change_pages", "tv_details"],
                                           f"SELECT {TV_OUT} FROM ({_COLLECTED_TV})")
ORACLE["pipeline_collect_then_apply_tv"] = _with(
    ["bronze_tv", "change_pages", "tv_details"],
    {"silver_tv": SILVER_TV, "collected": _COLLECTED_TV,
     "clean_collected": clean_tv("collected")}, f"""
SELECT {TV_OUT} FROM (
  SELECT * FROM silver_tv s WHERE NOT EXISTS (SELECT 1 FROM clean_collected c WHERE c.id = s.id)
  UNION ALL SELECT * FROM clean_collected)""")
# Days with an odd day of the month are moved ten years on, and all their pages fail in the rerun.
ORACLE["backfill_emptied_decade"] = _q(["discover_movie_records"], f"""
SELECT {MOVIE_OUT}, {DECADE} FROM ({_KEPT_RECORDS}) WHERE day(CAST(day AS DATE)) % 2 = 0""")

# -------------------------------------------------------------- streaming
_DETAIL_ROWS = f"""
SELECT id, title, overview, release_date, coalesce(vote_average, '{MOVIE_RATING_FILL}') AS vote_average,
       coalesce(genre_ids, CAST([] AS INTEGER[])) AS genre_ids
FROM movie_details WHERE ok"""
ORACLE["stream_apply_changes"] = _with(
    ["bronze_movies", "movie_details"],
    {"silver_movies": SILVER_MOVIES, "landed": _DETAIL_ROWS}, f"""
SELECT {MOVIE_OUT} FROM (
  SELECT * FROM silver_movies s WHERE NOT EXISTS (SELECT 1 FROM landed c WHERE c.id = s.id)
  UNION ALL SELECT * FROM landed)""")
ORACLE["stream_apply_twice"] = ORACLE["stream_apply_changes"]

# ------------------------------------------------- versions and day ranges
_LATEST = f"""
SELECT id, title, overview, release_date, vote_average, genre_ids FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched DESC) AS rn FROM detail_fetches WHERE ok) WHERE rn = 1"""
ORACLE["stream_latest_details"] = _with(
    ["bronze_movies", "detail_fetches"], {"silver_movies": SILVER_MOVIES, "latest": _LATEST}, f"""
SELECT {MOVIE_OUT} FROM (
  SELECT * FROM silver_movies s WHERE NOT EXISTS (SELECT 1 FROM latest c WHERE c.id = s.id)
  UNION ALL SELECT * FROM latest)""")
ORACLE["stream_window_counts"] = _q(["title_events"], """
SELECT strftime(CAST(happened_at AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS changes,
       min(id) AS least_id, max(id) AS greatest_id
FROM title_events
WHERE CAST(happened_at AS DATE) + INTERVAL 1 DAY <= (SELECT max(happened_at) FROM title_events) - INTERVAL 2 DAY
GROUP BY ALL""")


def _diff(old: str, new: str) -> str:
    same = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in _MOVIE_COLS)
    return f"""
SELECT coalesce(a.id, b.id) AS id,
       CASE WHEN a.id IS NULL THEN 'inserted' WHEN b.id IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM {old} a FULL JOIN {new} b ON a.id = b.id
WHERE NOT ({same})"""


_VERSION_CTES = SILVER_CTES | {"merged": APPLY_MOVIES}
ORACLE["snapshot_diff"] = _with(MOVIE_INPUTS, _VERSION_CTES, _diff("silver_movies", "merged"))
ORACLE["snapshot_diff_back"] = _with(MOVIE_INPUTS, _VERSION_CTES, _diff("merged", "silver_movies"))
ORACLE["snapshot_replay"] = ORACLE["apply_changes"]
ORACLE["validity_intervals"] = _q(["title_versions"], """
SELECT id, title, rating, CAST(epoch(changed_at) AS BIGINT) AS valid_from,
       CAST(epoch(lead(changed_at) OVER (PARTITION BY id ORDER BY changed_at)) AS BIGINT) AS valid_to
FROM (SELECT *, lag({'t': title, 'r': rating}) OVER (PARTITION BY id ORDER BY changed_at) AS before FROM title_versions)
WHERE before IS NULL OR before.t <> title OR before.r IS DISTINCT FROM rating""")
ORACLE["as_of_join"] = _q(["title_events", "title_versions"], """
SELECT e.event_id, e.id, CAST(floor(epoch(e.happened_at)) AS BIGINT) AS happened_at, v.title, v.rating,
       CAST(epoch(v.changed_at) AS BIGINT) AS version_at
FROM title_events e ASOF LEFT JOIN title_versions v ON e.id = v.id AND e.happened_at >= v.changed_at""")
_RANGES = """
SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS days
FROM (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS run FROM unlanded_days) GROUP BY run"""


def _isos(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in columns)


ORACLE["unlanded_ranges"] = _q(["unlanded_days"], f"SELECT {_isos('first_day', 'last_day')}, days FROM ({_RANGES})")
ORACLE["windows_unlanded"] = _q(["unlanded_days", "fetch_windows"], f"""
SELECT window_id, {_isos('window_first', 'window_last', 'first_day', 'last_day')}, days
FROM fetch_windows w JOIN ({_RANGES}) r ON w.window_first <= r.last_day AND r.first_day <= w.window_last""")

# ---------------------------------------------------------------- reports
ORACLE["walk_end_rollup"] = _q(["discover_pages"], f"""
SELECT decade, year, ended, CAST(grouping(decade, year, ended) AS INTEGER) AS level, count(*) AS days,
       CAST(sum(kept) AS BIGINT) AS pages
FROM (SELECT {DECADE}, CAST(year(CAST(day AS DATE)) AS INTEGER) AS year, ended, kept FROM (
  SELECT d.day, coalesce(k.pages_kept, 0) AS kept,
         CASE WHEN lp.page >= coalesce(lp.total_pages, 1) THEN 'last_page'
              WHEN np.page IS NULL THEN 'missing_page'
              WHEN np.status <> 200 OR NOT np.readable THEN 'failed_page' ELSE 'empty_page' END AS ended
  FROM (SELECT DISTINCT day FROM discover_pages WHERE page >= 1) d
  LEFT JOIN (SELECT day, count(*) AS pages_kept FROM ({walk('discover_pages', True, None)}) GROUP BY day) k ON k.day = d.day
  LEFT JOIN discover_pages lp ON lp.day = d.day AND lp.page = k.pages_kept
  LEFT JOIN discover_pages np ON np.day = d.day AND np.page = coalesce(k.pages_kept, 0) + 1))
GROUP BY ROLLUP (decade, year, ended)""")
_DAY_IDS = f"""
SELECT day, unnest([user_id * 7, user_id * 7 + 3]) AS id FROM ({_WALKED_CHANGES}) WHERE n_results = 2"""
ORACLE["distinct_sketches"] = _q(["change_pages"], " UNION ALL ".join(
    f"SELECT '{scope}' AS scope, {part} AS slice, count(DISTINCT id) AS ids, true AS within_bound "
    f"FROM ({_DAY_IDS}) GROUP BY ALL" for scope, part in
    (("day", "day"), ("month", "substr(day, 1, 7)"), ("all", "'all'"))))
ORACLE["top_titles"] = _q(["discover_movie_records"], f"""
SELECT decade, CAST(rank AS INTEGER) AS rank, id, title, vote_average FROM (
  SELECT *, row_number() OVER (PARTITION BY decade ORDER BY CAST(vote_average AS DOUBLE) DESC NULLS LAST, id) AS rank
  FROM (SELECT *, {DECADE} FROM ({_KEPT_RECORDS}))) WHERE rank <= 5""")

# ---------------------------------------------------------- text landings
ORACLE["landing_json"] = ORACLE["reshape_details"] + " AND id % 37 <> 5"
ORACLE["landing_csv"] = ORACLE["landing_json"]
ORACLE["landing_rejects"] = _q(["movie_details"], """
SELECT kind, count(*) AS rejects, true AS kept_whole
FROM movie_details, (SELECT unnest(['json', 'csv']) AS kind) WHERE id % 37 = 5 GROUP BY kind""")
