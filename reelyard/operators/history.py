"""Versions over time: snapshot differences, validity intervals, as-of joins.

A catalogue that is replaced version by version raises three questions that the
snapshots alone do not answer: what changed between two versions, from when to
when each state of a title was valid, and which state was valid when something
happened.  All three are plain Spark plans; a key that holds a third of all
rows is split by time buckets, never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelyard.functions.joins import DEFAULT_BROADCAST_BYTES, bounded_broadcast

DAY = 86_400


# ------------------------------------------------------- snapshot difference

def fingerprint(columns: list[str]) -> Column:
    """SHA-256 of the columns' values (nulls and empty values differ)."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """``key, change`` of every key that was ``inserted``, ``deleted`` or ``changed``.

    Both versions have one row per key and the same columns in any order.  Only
    keys and fingerprints are shuffled, once each, for one full outer join.
    """
    rest = sorted(c for c in old.columns if c != key)
    if rest != sorted(c for c in new.columns if c != key):
        raise ValueError(f"the versions differ in their columns: {old.columns}, {new.columns}")
    a = old.select(F.col(key), fingerprint(rest).alias("_old"))
    b = new.select(F.col(key).alias("_key"), fingerprint(rest).alias("_new"))
    both = a.join(b, F.col(key).eqNullSafe(F.col("_key")), "full")
    change = (F.when(F.col("_old").isNull(), "inserted").when(F.col("_new").isNull(), "deleted")
              .when(F.col("_old") != F.col("_new"), "changed"))
    there = F.when(F.col("_old").isNull(), F.col("_key")).otherwise(F.col(key))
    return both.select(there.alias(key), change.alias("change")).where(F.col("change").isNotNull())


def snapshot_delta(old: DataFrame, new: DataFrame, key: str = "id",
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``change`` and the new rows of inserted and changed keys; of deleted ones the key alone.

    The difference is stored once; behind the size bound it is broadcast, so the
    new version is filtered in place, beyond it both are shuffled by key.
    """
    diff, _ = bounded_broadcast(snapshot_diff(old, new, key), broadcast_bytes, materialize=True)
    gone = diff.where(F.col("change") == "deleted")
    rows = new.join(diff.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    none = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != key else F.col(key)
            for f in new.schema.fields]
    return rows.unionByName(gone.select(*none, "change"))


def replay(old: DataFrame, delta: DataFrame, key: str = "id",
           broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The new version, from the old one and ``snapshot_delta``."""
    keys, _ = bounded_broadcast(delta.select(F.col(key).alias("_key")), broadcast_bytes)
    kept = old.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return kept.unionByName(delta.where(F.col("change") != "deleted").drop("change"))


# ------------------------------------------------------------ validity

def _bucket(at: str, width: int) -> Column:
    return F.floor(F.unix_seconds(F.col(at)) / width)


def _neighbour(rows: DataFrame, key: str, at: str, value: Column, back: bool, width: int,
               name: str) -> DataFrame:
    """``rows`` with ``name``: ``struct(value)`` of the key's previous (or next)
    row in time, null where there is none.  Times of a key are distinct.

    The rows are sorted by (key, time bucket); across buckets the neighbour comes
    from one summary row per key and bucket.
    """
    step = F.lag if back else F.lead
    pick = F.max_by if back else F.min_by
    boxed = F.struct(value.alias("value"))
    rows = rows.withColumn("_bucket", _bucket(at, width))
    edges = (rows.groupBy(key, "_bucket").agg(pick(boxed, F.col(at)).alias("_edge"))
             .withColumn("_beyond", step("_edge").over(Window.partitionBy(key).orderBy("_bucket")))
             .select(F.col(key).alias("_k"), F.col("_bucket").alias("_b"), "_beyond"))
    inner = step(boxed).over(Window.partitionBy(key, "_bucket").orderBy(at))
    return (rows.withColumn(name, inner)
            .join(edges, (F.col(key) == F.col("_k")) & (F.col("_bucket") == F.col("_b")))
            .withColumn(name, F.coalesce(name, "_beyond"))
            .drop("_bucket", "_k", "_b", "_beyond"))


def validity_intervals(versions: DataFrame, key: str, at: str, columns: list[str],
                       width: int = 30 * DAY) -> DataFrame:
    """``key, columns, valid_from, valid_to`` of every state of every key.

    A state holds from its time up to, not including, the next state's time
    (null: still valid).  Consecutive equal states are one interval; of several
    rows of a key and time the greatest is taken; rows without key or time are
    left out.
    """
    once = (versions.where(F.col(key).isNotNull() & F.col(at).isNotNull())
            .groupBy(key, at).agg(F.max(F.struct(*columns)).alias("_state")))
    seen = _neighbour(once, key, at, F.col("_state"), True, width, "_before")
    new = F.col("_before").isNull() | ~F.col("_before.value").eqNullSafe(F.col("_state"))
    states = _neighbour(seen.where(new).drop("_before"), key, at, F.col(at), False, width, "_next")
    return states.select(key, *[F.col(f"_state.{c}").alias(c) for c in columns],
                         F.col(at).alias("valid_from"), F.col("_next.value").alias("valid_to"))


def as_of_join(events: DataFrame, versions: DataFrame, key: str, event_at: str, version_at: str,
               columns: list[str], width: int = DAY) -> DataFrame:
    """``events`` with the columns of the key's version that was valid at the event.

    That is the version of the greatest ``version_at`` not after ``event_at``
    (the greatest row of several); events without one, or without key or time,
    get nulls.  Versions before an event's time bucket are carried over as one
    row per key and bucket that has events.  Events, versions and these rows are
    then walked in time order per (key, bucket): a hot key is as many tasks as it
    has buckets (``width`` seconds), and events are shuffled once.
    """
    clash = set(columns) & set(events.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    known = F.col(key).isNotNull() & F.col(event_at).isNotNull()
    states = (versions.where(F.col(key).isNotNull() & F.col(version_at).isNotNull())
              .groupBy(key, F.col(version_at).alias("_at")).agg(F.max(F.struct(*columns)).alias("_state"))
              .withColumn("_bucket", _bucket("_at", width)))
    left = (events.where(known)
            .select(key, F.struct(*events.columns).alias("_event"), F.col(event_at).alias("_at"))
            .withColumn("_bucket", _bucket("_at", width)))
    box = F.struct(F.col("_state").alias("value"))
    # The last state of each earlier bucket, for the buckets that have events.
    last = states.groupBy(key, "_bucket").agg(F.max_by(box, F.col("_at")).alias("_box"))
    asked = left.select(key, "_bucket").distinct().withColumn("_box", F.lit(None).cast(last.schema["_box"].dataType))
    steps = (last.unionByName(asked).groupBy(key, "_bucket")
             .agg(F.max("_box").alias("_box"), F.bool_or(F.col("_box").isNull()).alias("_asked")))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (steps.withColumn("_box", F.last("_box", ignorenulls=True).over(before))
               .where(F.col("_asked") & F.col("_box").isNotNull()))

    def rows(df: DataFrame, order: int, event: Column, state: Column, at: Column) -> DataFrame:
        return df.select(key, "_bucket", F.lit(order).alias("_order"), at.alias("_at"),
                         event.cast(left.schema["_event"].dataType).alias("_event"),
                         state.cast(last.schema["_box"].dataType).alias("_box"))

    none = F.lit(None)
    walk = (rows(carried, 0, none, F.col("_box"), none.cast("timestamp"))
            .unionByName(rows(states, 1, none, box, F.col("_at").cast("timestamp")))
            .unionByName(rows(left, 2, F.col("_event"), none, F.col("_at").cast("timestamp"))))
    so_far = (Window.partitionBy(key, "_bucket").orderBy(F.col("_at").asc_nulls_first(), "_order")
              .rowsBetween(Window.unboundedPreceding, 0))
    found = (walk.withColumn("_box", F.last("_box", ignorenulls=True).over(so_far))
             .where(F.col("_event").isNotNull())
             .select("_event.*", *[F.col(f"_box.value.{c}").alias(c) for c in columns]))
    kinds = {f.name: f.dataType for f in versions.schema.fields}
    unknown = events.where(~known).select("*", *[F.lit(None).cast(kinds[c]).alias(c) for c in columns])
    return found.unionByName(unknown)
