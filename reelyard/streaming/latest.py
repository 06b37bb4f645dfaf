"""Stateful streams: the latest fetch of each id, and change counts per time window.

Both read landing folders as file streams and keep what they need from earlier
micro-batches in Spark's state store, bounded by a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructField, StructType, TimestampType

from reelyard.operators.ingest import reshape_details, typed_details
from reelyard.schemas import MediaSpec
from reelyard.sinks.snapshot import current_version
from reelyard.streaming.changes import FETCHED, LANDED_DETAIL_SCHEMA, apply_batch

LANDED_FETCH_SCHEMA = StructType([*LANDED_DETAIL_SCHEMA.fields, StructField("fetched_at", TimestampType(), True)])

DELAY = "10 days"


#: Ids that share a row of the state store: one call of Python, and one state, for 2 ** BLOCK_BITS neighbouring ids.
BLOCK_BITS = 8


def _newest_of_each(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per id: the newest, of several of one time the one with the greatest record."""
    ids, fetched = rows["id"].to_numpy(), rows["fetched"].to_numpy()
    order = np.lexsort((fetched, ids))
    ids, fetched = ids[order], fetched[order]
    last = np.append(ids[1:] != ids[:-1], True)
    best = order[last]
    tied = np.flatnonzero(~last & np.append((ids[1:] == ids[:-1]) & (fetched[1:] == fetched[:-1]), False))
    if len(tied):
        top = dict(zip(ids[last].tolist(), fetched[last].tolist(), strict=True))
        record = rows["record"].to_numpy()
        greatest = dict(zip(ids[last].tolist(), best.tolist(), strict=True))
        for at in tied.tolist():
            i = ids[at].item()
            if fetched[at] == top[i] and record[order[at]] > record[greatest[i]]:
                greatest[i] = order[at]
        best = np.fromiter(greatest.values(), dtype=np.int64, count=len(greatest))
    return rows.iloc[best]


def _newest(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest fetch of each id of a block if it is newer than the one remembered."""
    if state.hasTimedOut:
        state.remove()
        return
    best = None
    for part in parts:  # a hot block comes in several parts; only the best rows are held
        best = _newest_of_each(part if best is None else pd.concat([best, part], ignore_index=True))
    known: dict[int, int] = {}
    if state.exists:
        ids, times = state.get
        known = dict(zip(np.frombuffer(ids, np.int32).tolist(), np.frombuffer(times, np.int64).tolist(), strict=True))
    ids, fetched = best["id"].tolist(), best["fetched"].tolist()
    newer = [i not in known or t > known[i] for i, t in zip(ids, fetched, strict=True)]
    known |= {i: t for i, t, new in zip(ids, fetched, newer, strict=True) if new}
    if any(newer):
        yield best.loc[newer, ["id", "record", "fetched"]]
    # An id is forgotten once the watermark has passed: nothing older can arrive any more.
    passed = state.getCurrentWatermarkMs()
    kept = {i: t for i, t in known.items() if t // 1000 >= passed}
    if not kept:
        state.remove()
        return
    state.update((np.array(list(kept), np.int32).tobytes(), np.array(list(kept.values()), np.int64).tobytes()))
    state.setTimeoutTimestamp(max(max(kept.values()) // 1000, passed) + 1)


def latest_fetches(rows: DataFrame, spec: MediaSpec, delay: str = DELAY) -> DataFrame:
    """Of a stream of typed rows with their time in ``_fetched_at``, those that are
    the newest of their id so far.

    The state store holds one time per id, for as long as a fetch not newer than
    it may still come (ids side by side share a state row, so that Python is not
    called for each id): a fetch older than the watermark (``delay`` behind the
    newest one seen) is dropped by Spark, so an older fetch never follows a
    newer one, whatever micro-batch or run it lands in.  Of two fetches of one
    time the first one stays, within a batch the greatest.  Rows without a time
    are dropped.
    """
    record = F.to_json(F.struct(*spec.columns), {"ignoreNullFields": "false"})
    packed = (rows.where(F.col(FETCHED).isNotNull() & F.col("id").isNotNull())
              .withWatermark(FETCHED, delay)
              .select(F.shiftright("id", BLOCK_BITS).alias("block"), "id", record.alias("record"),
                      F.unix_micros(FETCHED).alias("fetched"), FETCHED))
    out = packed.groupBy("block").applyInPandasWithState(
        _newest, "id int, record string, fetched long", "ids binary, fetched binary", "update",
        GroupStateTimeout.EventTimeTimeout)
    typed = out.select(F.from_json("record", spec.schema).alias("_r"), F.timestamp_micros("fetched").alias(FETCHED))
    return typed.select("_r.*", FETCHED)


def landed_fetches(spark: SparkSession, landing_dir: str, spec: MediaSpec,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming catalogue rows of newly landed fetches that succeeded, with ``_fetched_at``."""
    reader = spark.readStream.schema(LANDED_FETCH_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ok = reader.parquet(landing_dir).where(F.col("status") == 200).withColumnRenamed("fetched_at", FETCHED)
    return reshape_details(typed_details(ok, spec, keep=(FETCHED,)), spec, keep=(FETCHED,))


def apply_latest_fetches(spark: SparkSession, landing_dir: str, silver_path: str, spec: MediaSpec,
                         checkpoint: str, delay: str = DELAY,
                         max_files_per_trigger: int | None = None) -> int | None:
    """Upsert the newest fetches landed since the last run; returns the silver version."""
    rows = latest_fetches(landed_fetches(spark, landing_dir, spec, max_files_per_trigger), spec, delay)
    q = (rows.writeStream.outputMode("update")
         .foreachBatch(apply_batch(silver_path, spec))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return current_version(spark, silver_path)


def window_counts(changes: DataFrame, at: str, by: list[str], width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Changes per time window and ``by``: ``window_start, by, changes, ids`` columns of a stream.

    A window is given out once, when the watermark (``delay`` behind the newest
    change seen) has passed its end; changes that come later than that are dropped.
    State is one row per open window and group, partially aggregated before the
    shuffle, so a day with most of the changes is one row per task.
    """
    counts = (changes.withWatermark(at, delay).groupBy(F.window(at, width).alias("_w"), *by)
              .agg(F.count(F.lit(1)).alias("changes"), F.min("id").alias("least_id"), F.max("id").alias("greatest_id")))
    return counts.select(F.col("_w.start").alias("window_start"), *by, "changes", "least_id", "greatest_id")


def count_landed_changes(spark: SparkSession, landing_dir: str, schema: StructType, at: str, by: list[str],
                         out: str, checkpoint: str, width: str = "1 day", delay: str = "2 days",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Count what has landed since the last run; closed windows are appended to ``out``, which is returned."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counts = window_counts(reader.parquet(landing_dir), at, by, width, delay)
    q = (counts.writeStream.outputMode("append").format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)
