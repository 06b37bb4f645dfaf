"""Catalogue inputs derived from the driver's tables, in Spark and in SQL.

The reference lands paged JSON responses and catalogue slices; the driver's
tables have neither, nor any nulls or duplicate keys.  Every fixture below is a
whole-table projection of a driver table: nulls, empty values and failures are
injected by fixed arithmetic on the row's own key (a value rule, never a row
filter), duplicates come from a second slice over the labelled documents, and
JSON bodies are rendered with ``to_json`` so that the operators under test parse
real JSON text.

``SQL`` holds the same inputs as DuckDB ``SELECT`` statements over the
driver's views, already typed (the oracle has no JSON step), so an operator
result in Spark is checked against an independent formulation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelyard.functions.columns import iso_day


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_if(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    return docs.join(labels, "doc_id", "left_semi")


# --------------------------------------------------------------------------
# Catalogue slices and change sets
# --------------------------------------------------------------------------

def bronze_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping movie slices with a ``slice`` version column."""
    d = F.col("doc_id")
    s0 = table(spark, sf_dir, "documents").select(
        _null_if(d % 17 == 0, d).cast("int").alias("id"),
        F.when(d % 11 == 0, F.lit(None)).when(d % 19 == 0, F.lit(""))
        .otherwise(F.col("source")).alias("title"),
        _null_if(d % 5 == 0, F.col("text")).alias("overview"),
        _null_if(d % 7 == 0, F.concat(F.lit("2020-01-0"), (d % 9 + 1).cast("string")))
        .alias("release_date"),
        _null_if(d % 13 == 0, F.col("n_chars").cast("string")).alias("vote_average"),
        F.when(d % 3 == 0, F.lit(None))
        .when(d % 4 == 1, F.array((d % 5).cast("int"), F.lit(None).cast("int")))
        .otherwise(F.array((d % 5).cast("int"), (d % 7).cast("int"))).alias("genre_ids"),
        F.lit(0).alias("slice"),
    )
    s1 = _labelled(spark, sf_dir).select(
        d.cast("int").alias("id"),
        F.concat(F.col("source"), F.lit("_v2")).alias("title"),
        F.col("text").alias("overview"),
        F.lit(None).cast("string").alias("release_date"),
        F.col("n_chars").cast("string").alias("vote_average"),
        F.array((d % 5).cast("int"), (d % 7).cast("int")).alias("genre_ids"),
        F.lit(1).alias("slice"),
    )
    return s0.unionByName(s1)


def movie_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change row per label; every tenth id is new to the catalogue."""
    d, q, x = F.col("doc_id"), F.col("quality"), F.col("toxic")
    return table(spark, sf_dir, "labels").select(
        F.when(d % 10 == 0, d + 1000000).otherwise(d).cast("int").alias("id"),
        _null_if(d % 23 == 0, F.concat(F.lit("chg"), q.cast("string"))).alias("title"),
        _null_if(q == 0, F.lit("changed")).alias("overview"),
        F.lit("2024-02-12").alias("release_date"),
        F.concat(x.cast("string"), F.lit(".5")).alias("vote_average"),
        _null_if(x == 1, F.array(q.cast("int"))).alias("genre_ids"),
    )


def bronze_tv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping TV slices with a ``slice`` version column."""
    d = F.col("doc_id")
    s0 = table(spark, sf_dir, "documents").select(
        _null_if(d % 3 == 0, F.array((d % 5).cast("int"))).alias("genre_ids"),
        _null_if(d % 17 == 0, d).cast("int").alias("id"),
        _null_if(d % 8 == 0, F.array(F.upper(F.col("lang")))).alias("origin_country"),
        _null_if(d % 5 == 0, F.col("lang")).alias("original_language"),
        _null_if(d % 6 == 0, F.concat(F.col("source"), F.lit("_o"))).alias("original_name"),
        _null_if(d % 10 == 0, F.col("text")).alias("overview"),
        _null_if(d % 7 == 0, F.concat(F.lit("2021-03-0"), (d % 9 + 1).cast("string")))
        .alias("first_air_date"),
        _null_if(d % 4 == 0, F.col("source")).alias("name"),
        F.when(d % 13 == 0, F.lit(None)).when(d % 19 == 0, F.lit(float("nan")))
        .otherwise(F.col("n_chars").cast("double")).alias("vote_average"),
        F.lit(0).alias("slice"),
    )
    s1 = _labelled(spark, sf_dir).select(
        F.array((d % 7).cast("int")).alias("genre_ids"),
        d.cast("int").alias("id"),
        F.array(F.lit("US")).alias("origin_country"),
        F.col("lang").alias("original_language"),
        F.lit(None).cast("string").alias("original_name"),
        F.col("text").alias("overview"),
        F.lit(None).cast("string").alias("first_air_date"),
        F.concat(F.col("source"), F.lit("_v2")).alias("name"),
        (F.col("n_chars").cast("double") / 10).alias("vote_average"),
        F.lit(1).alias("slice"),
    )
    return s0.unionByName(s1)


def tv_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, q, x = F.col("doc_id"), F.col("quality"), F.col("toxic")
    return table(spark, sf_dir, "labels").select(
        F.array(q.cast("int")).alias("genre_ids"),
        F.when(d % 10 == 0, d + 1000000).otherwise(d).cast("int").alias("id"),
        _null_if(x == 1, F.array(F.lit("BR"))).alias("origin_country"),
        F.lit(None).cast("string").alias("original_language"),
        F.lit("chg_o").alias("original_name"),
        _null_if(q == 0, F.lit("changed")).alias("overview"),
        F.lit("2024-02-12").alias("first_air_date"),
        _null_if(d % 23 == 0, F.lit("chg")).alias("name"),
        (q.cast("double") + 0.5).alias("vote_average"),
    )


# --------------------------------------------------------------------------
# Landed responses: one row per fetched page or detail, body as JSON text
# --------------------------------------------------------------------------

ERROR_BODY = '{"status_code": 34, "status_message": "The resource could not be found."}'


# A body cut short in transit: a 200 response that is no JSON.
def _cut_short(body: Column) -> Column:
    return F.substring(body, 1, 9)


def _empty_like(arr: Column) -> Column:
    return F.filter(arr, lambda _: F.lit(False))


def _discover_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = F.col("conv_id"), F.col("turn")
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", "text",
        iso_day(F.date_add(F.lit("1970-01-01").cast("date"), (c * 20).cast("int"))).alias("day"),
        (t + 1).cast("int").alias("page"),
        F.when((c % 9 == 0) & (t == 2), 500).otherwise(200).alias("status"),
        F.when(c % 5 == 0, 2).when(c % 11 == 1, F.lit(None)).otherwise(99)
        .cast("int").alias("total_pages"),
        ((c % 7 == 0) & (t == 3)).alias("empty"),
        ((c % 13 == 5) & (t == 1)).alias("cut"),
    )


def _pages(frame: DataFrame, r1: Column, r2: Column) -> DataFrame:
    t = F.col("turn")
    results = (F.when(F.col("empty"), _empty_like(F.array(r1)))
               .when(t % 2 == 0, F.array(r1, r2))
               .otherwise(F.array(r1)))
    body = F.to_json(F.struct(F.col("page"), F.col("total_pages"), results.alias("results")))
    return frame.select(
        "day", "page", "status",
        F.when(F.col("status") != 200, F.lit(ERROR_BODY)).when(F.col("cut"), _cut_short(body))
        .otherwise(body).alias("body"),
    )


def discover_movie_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed discover pages for movies: ``day, page, status, body``."""
    c, t = F.col("conv_id"), F.col("turn")
    r1 = F.struct(
        (c * 100 + t).cast("int").alias("id"),
        F.col("role").alias("title"),
        F.col("text").alias("overview"),
        F.col("day").alias("release_date"),
        ((c % 100).cast("double") / 10).alias("vote_average"),
        F.array(t.cast("int"), (c % 19).cast("int")).alias("genre_ids"),
        F.lit(1.5).alias("popularity"),
    )
    r2 = F.struct(
        (c * 100 + 50 + t).cast("int").alias("id"),
        F.concat(F.col("role"), F.lit("_2")).alias("title"),
        F.lit(None).cast("string").alias("overview"),
        F.col("day").alias("release_date"),
        F.lit(None).cast("double").alias("vote_average"),
        F.lit(None).cast("array<int>").alias("genre_ids"),
        F.lit(2.5).alias("popularity"),
    )
    return _pages(_discover_frame(spark, sf_dir), r1, r2)


def discover_tv_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed discover pages for TV shows: ``day, page, status, body``."""
    c, t = F.col("conv_id"), F.col("turn")
    r1 = F.struct(
        F.array(t.cast("int"), (c % 19).cast("int")).alias("genre_ids"),
        (c * 100 + t).cast("int").alias("id"),
        F.array(F.upper(F.col("role"))).alias("origin_country"),
        F.col("role").alias("original_language"),
        F.concat(F.col("role"), F.lit("_o")).alias("original_name"),
        F.col("text").alias("overview"),
        F.col("day").alias("first_air_date"),
        F.col("role").alias("name"),
        ((c % 100).cast("double") / 10).alias("vote_average"),
        F.lit(1.5).alias("popularity"),
    )
    r2 = F.struct(
        F.lit(None).cast("array<int>").alias("genre_ids"),
        (c * 100 + 50 + t).cast("int").alias("id"),
        F.lit(None).cast("array<string>").alias("origin_country"),
        F.lit(None).cast("string").alias("original_language"),
        F.col("role").alias("original_name"),
        F.lit(None).cast("string").alias("overview"),
        F.col("day").alias("first_air_date"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("double").alias("vote_average"),
        F.lit(2.5).alias("popularity"),
    )
    return _pages(_discover_frame(spark, sf_dir), r1, r2)


def change_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed change-list pages from ``events``: one page per event and day.

    Pages are numbered per day in event order (event ids are consecutive within
    a day, so the number is the offset from the day's first event: one partial
    aggregate per day, no window).  The reported ``total_pages`` is the landed
    count plus two (so the walk ends on the missing page), 100 on days
    ``3, 10, 17, 24, 31`` and missing on days ``5, 16, 27``.
    """
    from reelyard.functions.joins import bounded_broadcast

    ev = table(spark, sf_dir, "events").withColumn("day", iso_day(F.to_date("ts")))
    per_day = ev.groupBy("day").agg(F.min("event_id").alias("first_event"),
                                    F.count(F.lit(1)).alias("n_events"))
    per_day, _ = bounded_broadcast(per_day)
    dom = F.dayofmonth(F.to_date("day"))
    u, e = F.col("user_id"), F.col("event_id")
    framed = ev.join(per_day, "day").select(
        "day",
        (e - F.col("first_event") + 1).cast("int").alias("page"),
        F.when(e % 997 == 500, 500).otherwise(200).alias("status"),
        F.when(dom % 7 == 3, 100).when(dom % 11 == 5, F.lit(None))
        .otherwise(F.col("n_events") + 2).cast("int").alias("total_pages"),
        F.when((F.col("event_type") == "view") & (F.col("value") < 5.0),
               F.array().cast("array<struct<id:int,adult:boolean>>"))
        .otherwise(F.array(
            F.struct((u * 7).cast("int").alias("id"), F.lit(False).alias("adult")),
            F.struct((u * 7 + 3).cast("int").alias("id"), F.lit(False).alias("adult")),
        )).alias("results"),
        (e % 991 == 350).alias("cut"),
    )
    body = F.to_json(F.struct("page", "total_pages", "results"))
    return framed.select(
        "day", "page", "status",
        F.when(F.col("status") != 200, F.lit(ERROR_BODY)).when(F.col("cut"), _cut_short(body))
        .otherwise(body).alias("body"),
    )


def movie_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed movie detail responses: ``id, status, body``."""
    d = F.col("doc_id")
    genres = F.array(
        F.struct((d % 5).cast("int").alias("id"), F.col("lang").alias("name")),
        F.struct((d % 7).cast("int").alias("id"), F.col("source").alias("name")),
    )
    body = F.to_json(F.struct(
        d.cast("int").alias("id"),
        F.col("source").alias("title"),
        F.col("text").alias("overview"),
        F.concat(F.lit("2019-05-0"), (d % 9 + 1).cast("string")).alias("release_date"),
        _null_if(d % 13 == 0, (F.col("n_chars") % 100).cast("double") / 10).alias("vote_average"),
        _null_if(d % 3 == 0, genres).alias("genres"),
        F.col("n_chars").alias("runtime"),
    ))
    status = F.when(d % 29 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "documents").select(
        d.cast("int").alias("id"), status.alias("status"),
        F.when(status != 200, F.lit(ERROR_BODY)).when(d % 31 == 7, _cut_short(body))
        .otherwise(body).alias("body"),
    )


def tv_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed TV detail responses: ``id, status, body``."""
    d = F.col("doc_id")
    genres = F.array(F.struct((d % 5).cast("int").alias("id"), F.col("lang").alias("name")))
    body = F.to_json(F.struct(
        d.cast("int").alias("id"),
        F.col("source").alias("name"),
        F.concat(F.col("source"), F.lit("_o")).alias("original_name"),
        F.col("lang").alias("original_language"),
        F.col("text").alias("overview"),
        F.concat(F.lit("2018-07-0"), (d % 9 + 1).cast("string")).alias("first_air_date"),
        _null_if(d % 8 == 0, F.array(F.upper(F.col("lang")))).alias("origin_country"),
        _null_if(d % 13 == 0, (F.col("n_chars") % 100).cast("double") / 10).alias("vote_average"),
        _null_if(d % 3 == 0, genres).alias("genres"),
    ))
    status = F.when(d % 29 == 0, 404).otherwise(200)
    return table(spark, sf_dir, "documents").select(
        d.cast("int").alias("id"), status.alias("status"),
        F.when(status != 200, F.lit(ERROR_BODY)).when(d % 31 == 7, _cut_short(body))
        .otherwise(body).alias("body"),
    )


# --------------------------------------------------------------------------
# Several fetches and versions of a title over time
# --------------------------------------------------------------------------

# 2024-01-01 00:00:00 UTC, the first day of ``events``.
FIRST_SECOND = 1_704_067_200


def _at(hours: Column) -> Column:
    return F.timestamp_seconds(F.lit(FIRST_SECOND) + hours * 3600)


def detail_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landed fetches of each movie detail, in no order: ``id, status, body, fetched_at, k``."""
    d, k = F.col("doc_id"), F.col("k")
    body = F.to_json(F.struct(
        d.cast("int").alias("id"),
        F.concat(F.col("source"), F.lit("_f"), k.cast("string")).alias("title"),
        F.col("text").alias("overview"),
        F.lit("2019-05-01").alias("release_date"),
        F.lit(6.5).alias("vote_average"),
        _null_if(d % 3 == 0, F.array(F.struct((d % 5).cast("int").alias("id"), F.col("lang").alias("name")))).alias("genres"),
    ))
    status = F.when((d + k) % 29 == 0, 404).otherwise(200)
    return (table(spark, sf_dir, "documents").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(2))))
            .select(d.cast("int").alias("id"), status.alias("status"),
                    F.when(status != 200, F.lit(ERROR_BODY)).when((d + k) % 31 == 7, _cut_short(body))
                    .otherwise(body).alias("body"),
                    _at((d * 37 + k * 53) % 90).alias("fetched_at"), k.cast("int").alias("k")))


def title_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four dated states of each title: ``id, title, rating, changed_at``; some repeat the state before."""
    d, k = F.col("doc_id"), F.col("k")
    state = (k % 3 == 0).cast("int")
    return (table(spark, sf_dir, "documents").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .select(d.cast("int").alias("id"), F.concat(F.col("source"), F.lit("_"), state.cast("string")).alias("title"),
                    _null_if(d % 6 == 0, ((d + state) % 10).cast("int")).alias("rating"),
                    _at((d * 37 + k * 53) % 120 * 6).alias("changed_at")))


def title_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated events of titles; every third one is of title 7: ``event_id, id, event_type, happened_at``."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(e % 3 == 0, 7).otherwise(F.col("user_id")).cast("int").alias("id"),
        "event_type", F.col("ts").cast("timestamp").alias("happened_at"))


def fetch_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day windows to be fetched, some of over a year: ``window_id, window_first, window_last``."""
    k = F.col("o_orderkey")
    first = F.to_date("o_orderdate")
    days = F.when(k % 97 == 0, 400).otherwise(k % 9).cast("int")
    return table(spark, sf_dir, "orders").select(
        k.alias("window_id"), first.alias("window_first"), F.date_add(first, days).alias("window_last"))


def unlanded(day: Column) -> Column:
    """Days that failed to land, alone and in stretches."""
    n = F.datediff(F.to_date(day), F.lit("1970-01-01").cast("date"))
    return (n % 11).isin(3, 4, 5) | (n % 97 < 20)


# --------------------------------------------------------------------------
# The same inputs for DuckDB, already typed
# --------------------------------------------------------------------------

SQL: dict[str, str] = {}

SQL["bronze_movies"] = """
SELECT CAST(CASE WHEN doc_id % 17 = 0 THEN NULL ELSE doc_id END AS INTEGER) AS id,
       CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '' ELSE source END AS title,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END AS overview,
       CASE WHEN doc_id % 7 = 0 THEN NULL
            ELSE '2020-01-0' || CAST(doc_id % 9 + 1 AS VARCHAR) END AS release_date,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE CAST(n_chars AS VARCHAR) END AS vote_average,
       CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 4 = 1 THEN [CAST(doc_id % 5 AS INTEGER), NULL]
            ELSE [CAST(doc_id % 5 AS INTEGER), CAST(doc_id % 7 AS INTEGER)] END AS genre_ids,
       0 AS slice
FROM documents
UNION ALL
SELECT CAST(doc_id AS INTEGER), source || '_v2', text, CAST(NULL AS VARCHAR),
       CAST(n_chars AS VARCHAR),
       [CAST(doc_id % 5 AS INTEGER), CAST(doc_id % 7 AS INTEGER)], 1
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
"""

SQL["movie_changes"] = """
SELECT CAST(CASE WHEN doc_id % 10 = 0 THEN doc_id + 1000000 ELSE doc_id END AS INTEGER) AS id,
       CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'chg' || CAST(quality AS VARCHAR) END AS title,
       CASE WHEN quality = 0 THEN NULL ELSE 'changed' END AS overview,
       '2024-02-12' AS release_date,
       CAST(toxic AS VARCHAR) || '.5' AS vote_average,
       CASE WHEN toxic = 1 THEN NULL ELSE [CAST(quality AS INTEGER)] END AS genre_ids
FROM labels
"""

SQL["bronze_tv"] = """
SELECT CASE WHEN doc_id % 3 = 0 THEN NULL ELSE [CAST(doc_id % 5 AS INTEGER)] END AS genre_ids,
       CAST(CASE WHEN doc_id % 17 = 0 THEN NULL ELSE doc_id END AS INTEGER) AS id,
       CASE WHEN doc_id % 8 = 0 THEN NULL ELSE [upper(lang)] END AS origin_country,
       CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS original_language,
       CASE WHEN doc_id % 6 = 0 THEN NULL ELSE source || '_o' END AS original_name,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE text END AS overview,
       CASE WHEN doc_id % 7 = 0 THEN NULL
            ELSE '2021-03-0' || CAST(doc_id % 9 + 1 AS VARCHAR) END AS first_air_date,
       CASE WHEN doc_id % 4 = 0 THEN NULL ELSE source END AS name,
       CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN CAST('NaN' AS DOUBLE)
            ELSE CAST(n_chars AS DOUBLE) END AS vote_average,
       0 AS slice
FROM documents
UNION ALL
SELECT [CAST(doc_id % 7 AS INTEGER)], CAST(doc_id AS INTEGER), ['US'], lang,
       CAST(NULL AS VARCHAR), text, CAST(NULL AS VARCHAR), source || '_v2',
       CAST(n_chars AS DOUBLE) / 10, 1
FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
"""

SQL["tv_changes"] = """
SELECT [CAST(quality AS INTEGER)] AS genre_ids,
       CAST(CASE WHEN doc_id % 10 = 0 THEN doc_id + 1000000 ELSE doc_id END AS INTEGER) AS id,
       CASE WHEN toxic = 1 THEN NULL ELSE ['BR'] END AS origin_country,
       CAST(NULL AS VARCHAR) AS original_language,
       'chg_o' AS original_name,
       CASE WHEN quality = 0 THEN NULL ELSE 'changed' END AS overview,
       '2024-02-12' AS first_air_date,
       CASE WHEN doc_id % 23 = 0 THEN NULL ELSE 'chg' END AS name,
       CAST(quality AS DOUBLE) + 0.5 AS vote_average
FROM labels
"""

# Typed discover pages: one row per landed page (``n_results`` null on errors).
SQL["discover_pages"] = """
SELECT strftime(DATE '1970-01-01' + CAST(conv_id * 20 AS INTEGER), '%Y-%m-%d') AS day,
       CAST(turn + 1 AS INTEGER) AS page,
       CASE WHEN conv_id % 9 = 0 AND turn = 2 THEN 500 ELSE 200 END AS status,
       NOT (conv_id % 13 = 5 AND turn = 1) AS readable,
       CASE WHEN conv_id % 9 = 0 AND turn = 2 OR conv_id % 13 = 5 AND turn = 1 THEN NULL
            WHEN conv_id % 5 = 0 THEN 2 WHEN conv_id % 11 = 1 THEN NULL ELSE 99 END AS total_pages,
       CASE WHEN conv_id % 9 = 0 AND turn = 2 OR conv_id % 13 = 5 AND turn = 1 THEN NULL
            WHEN conv_id % 7 = 0 AND turn = 3 THEN 0
            WHEN turn % 2 = 0 THEN 2 ELSE 1 END AS n_results,
       conv_id, turn, role, text
FROM conversations
"""

# Typed movie records of every successful page (r1 and, on even turns, r2).
SQL["discover_movie_records"] = """
SELECT day, page, CAST(conv_id * 100 + turn AS INTEGER) AS id, role AS title, text AS overview,
       day AS release_date, CAST(CAST(conv_id % 100 AS DOUBLE) / 10 AS VARCHAR) AS vote_average,
       [CAST(turn AS INTEGER), CAST(conv_id % 19 AS INTEGER)] AS genre_ids
FROM discover_pages WHERE status = 200 AND n_results >= 1
UNION ALL
SELECT day, page, CAST(conv_id * 100 + 50 + turn AS INTEGER), role || '_2', CAST(NULL AS VARCHAR),
       day, CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER[])
FROM discover_pages WHERE status = 200 AND n_results = 2
"""

SQL["discover_tv_records"] = """
SELECT day, page, [CAST(turn AS INTEGER), CAST(conv_id % 19 AS INTEGER)] AS genre_ids,
       CAST(conv_id * 100 + turn AS INTEGER) AS id, [upper(role)] AS origin_country,
       role AS original_language, role || '_o' AS original_name, text AS overview,
       day AS first_air_date, role AS name, CAST(conv_id % 100 AS DOUBLE) / 10 AS vote_average
FROM discover_pages WHERE status = 200 AND n_results >= 1
UNION ALL
SELECT day, page, CAST([] AS INTEGER[]), CAST(conv_id * 100 + 50 + turn AS INTEGER),
       CAST([] AS VARCHAR[]), CAST(NULL AS VARCHAR), role, CAST(NULL AS VARCHAR), day,
       CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)
FROM discover_pages WHERE status = 200 AND n_results = 2
"""

SQL["change_pages"] = """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day,
       CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS INTEGER) AS page,
       CASE WHEN event_id % 997 = 500 THEN 500 ELSE 200 END AS status,
       event_id % 997 = 500 OR event_id % 991 <> 350 AS readable,
       CASE WHEN event_id % 997 = 500 OR event_id % 991 = 350 THEN NULL
            WHEN day(CAST(ts AS DATE)) % 7 = 3 THEN 100
            WHEN day(CAST(ts AS DATE)) % 11 = 5 THEN NULL
            ELSE CAST(count(*) OVER (PARTITION BY CAST(ts AS DATE)) + 2 AS INTEGER) END AS total_pages,
       CASE WHEN event_id % 997 = 500 OR event_id % 991 = 350 THEN NULL
            WHEN event_type = 'view' AND value < 5.0 THEN 0 ELSE 2 END AS n_results,
       user_id
FROM events
"""

SQL["movie_details"] = """
SELECT CAST(doc_id AS INTEGER) AS id,
       CASE WHEN doc_id % 29 = 0 THEN 404 ELSE 200 END AS status,
       doc_id % 29 <> 0 AND doc_id % 31 <> 7 AS ok,
       source AS title, text AS overview,
       '2019-05-0' || CAST(doc_id % 9 + 1 AS VARCHAR) AS release_date,
       CASE WHEN doc_id % 13 = 0 THEN NULL
            ELSE CAST(CAST(n_chars % 100 AS DOUBLE) / 10 AS VARCHAR) END AS vote_average,
       CASE WHEN doc_id % 3 = 0 THEN NULL
            ELSE [CAST(doc_id % 5 AS INTEGER), CAST(doc_id % 7 AS INTEGER)] END AS genre_ids
FROM documents
"""

SQL["tv_details"] = """
SELECT CAST(doc_id AS INTEGER) AS id,
       CASE WHEN doc_id % 29 = 0 THEN 404 ELSE 200 END AS status,
       doc_id % 29 <> 0 AND doc_id % 31 <> 7 AS ok,
       CASE WHEN doc_id % 3 = 0 THEN NULL ELSE [CAST(doc_id % 5 AS INTEGER)] END AS genre_ids,
       CASE WHEN doc_id % 8 = 0 THEN CAST([] AS VARCHAR[]) ELSE [upper(lang)] END AS origin_country,
       lang AS original_language, source || '_o' AS original_name, text AS overview,
       '2018-07-0' || CAST(doc_id % 9 + 1 AS VARCHAR) AS first_air_date,
       source AS name,
       CASE WHEN doc_id % 13 = 0 THEN NULL ELSE CAST(n_chars % 100 AS DOUBLE) / 10 END AS vote_average
FROM documents
"""

SQL["detail_fetches"] = f"""
SELECT CAST(doc_id AS INTEGER) AS id, (doc_id + k) % 29 <> 0 AND (doc_id + k) % 31 <> 7 AS ok,
       source || '_f' || CAST(k AS VARCHAR) AS title, text AS overview, '2019-05-01' AS release_date,
       '6.5' AS vote_average,
       CASE WHEN doc_id % 3 = 0 THEN CAST([] AS INTEGER[]) ELSE [CAST(doc_id % 5 AS INTEGER)] END AS genre_ids,
       {FIRST_SECOND} + ((doc_id * 37 + k * 53) % 90) * 3600 AS fetched
FROM documents, (SELECT unnest([0, 1, 2]) AS k)
"""

SQL["title_versions"] = f"""
SELECT CAST(doc_id AS INTEGER) AS id, source || '_' || CAST(CAST(k % 3 = 0 AS INTEGER) AS VARCHAR) AS title,
       CASE WHEN doc_id % 6 = 0 THEN NULL ELSE CAST((doc_id + CAST(k % 3 = 0 AS INTEGER)) % 10 AS INTEGER) END AS rating,
       to_timestamp({FIRST_SECOND} + ((doc_id * 37 + k * 53) % 120) * 21600) AT TIME ZONE 'UTC' AS changed_at
FROM documents, (SELECT unnest([0, 1, 2, 3]) AS k)
"""

SQL["title_events"] = """
SELECT event_id, CAST(CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS INTEGER) AS id, event_type, ts AS happened_at
FROM events
"""

SQL["fetch_windows"] = """
SELECT o_orderkey AS window_id, CAST(o_orderdate AS DATE) AS window_first,
       CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderkey % 97 = 0 THEN 400 ELSE o_orderkey % 9 END AS INTEGER) AS window_last
FROM orders
"""

# Days of the orders' years that did not land.
SQL["unlanded_days"] = """
SELECT CAST(d AS DATE) AS day
FROM (SELECT unnest(generate_series(make_date(CAST(year(min(o_orderdate)) AS BIGINT), 1, 1),
                                    make_date(CAST(year(max(o_orderdate)) AS BIGINT), 12, 31),
                                    INTERVAL 1 DAY)) AS d FROM orders)
WHERE (CAST(d AS DATE) - DATE '1970-01-01') % 11 IN (3, 4, 5) OR (CAST(d AS DATE) - DATE '1970-01-01') % 97 < 20
"""

# Which fixtures each fixture reads (for assembling WITH clauses in order).
SQL_DEPS = {
    "discover_movie_records": ["discover_pages"],
    "discover_tv_records": ["discover_pages"],
}


def with_fixtures(names: list[str], body: str) -> str:
    """``WITH <fixtures> <body>`` with dependencies first, each once."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for dep in SQL_DEPS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({SQL[n].strip()})" for n in ordered)
    return f"WITH {ctes}\n{body.strip()}"
