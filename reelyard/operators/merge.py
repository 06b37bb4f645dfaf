"""Whole-row upsert by key: left-anti join plus union by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelyard.functions.joins import (
    DEFAULT_BROADCAST_BYTES,
    Stored,
    bounded_broadcast,
    materialize_table,
)
from reelyard.operators.clean import clean, greatest_rows
from reelyard.schemas import MediaSpec


def anti_join(left: DataFrame, right: DataFrame, key: str = "id",
              broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, materialize: bool = True,
              right_bytes: int | None = None) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``right``.

    Only the right side's key column takes part.  When it is within the proven
    bound it is broadcast, so the (large) left side is streamed once with no
    shuffle at all; above it Spark plans a shuffle join (AQE can split skewed
    partitions).  A derived key side is stored once (``materialize``) so the
    size check does not recompute it; a caller that already knows the size of a
    stored ``right`` passes ``right_bytes``.  A null key on the left never
    matches and is kept.  Output columns are ``left``'s, in its order.
    """
    keys = right.select(key)
    if right_bytes is not None:
        if right_bytes <= broadcast_bytes:
            keys = F.broadcast(keys)
    else:
        keys, _ = bounded_broadcast(keys, broadcast_bytes, materialize)
    return left.join(keys, on=key, how="left_anti").select(*left.columns)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name, in ``a``'s order."""
    return a.unionByName(b).select(*a.columns)


def latest_changes(changes: DataFrame, columns: list[str], key: str = "id",
                   order: tuple = ()) -> Stored:
    """The change set de-duplicated by key, stored once under the shared
    scratch folder, with its size.

    Both sides of the upsert (the anti join's keys and the inserted rows) read
    this one table, so the change set is de-duplicated once and its size is
    known before the join is planned.  ``order`` names version columns of
    ``changes`` (newest wins); they are dropped after the de-duplication.
    """
    # One pass: a micro-batch must not be computed twice.
    rest = [c for c in columns if c != key]
    latest = greatest_rows(changes.select(key, *order, *rest), key).select(*columns)
    return materialize_table(latest, "changes")


def upsert(base: DataFrame, changes: DataFrame, key: str = "id",
           order: tuple = (), broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Whole-row upsert (J2): a change row replaces the base row with its key,
    new keys are inserted, nothing is deleted.

    The change set is de-duplicated by key first (deterministic survivor), so
    applying it twice gives the same result as applying it once.
    """
    latest, _, size = latest_changes(changes, base.columns, key, order)
    return union_by_name(anti_join(base, latest, key, broadcast_bytes, right_bytes=size), latest)


def apply_changes(silver: DataFrame, changes: DataFrame, spec: MediaSpec,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Clean both sides (a no-op on clean silver), then upsert."""
    return upsert(clean(silver, spec).select(*spec.silver_order),
                  clean(changes, spec).select(*spec.silver_order),
                  "id", (), broadcast_bytes)
