"""Bronze -> silver cleaning operators (C1-C8) and de-duplication.

All are narrow ``DataFrame -> DataFrame`` projections/filters except the
de-duplication, which finds the winners on keys and versions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelyard.functions.columns import or_empty
from reelyard.functions.joins import DEFAULT_BROADCAST_BYTES, materialize_table
from reelyard.schemas import MediaSpec


def keys_present(columns: tuple[str, ...]) -> Column:
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def require_keys(df: DataFrame, columns: tuple[str, ...] = ("id", "title")) -> DataFrame:
    """Keep rows whose key columns are all non-null.

    ``IS NOT NULL`` conjuncts are pushed to the Parquet scan.  Empty strings
    are values, not nulls.
    """
    return df.filter(keys_present(columns))


def require_keys_steps(df: DataFrame, columns: tuple[str, ...] = ("id", "title")) -> DataFrame:
    """Rows removed by each key rule in turn, in one pass.

    One row: ``input_rows``, ``removed_<col>`` for each column (rows that pass
    the earlier rules but have this column null), ``kept_rows``.
    """
    aggs = [F.count(F.lit(1)).alias("input_rows")]
    passed = F.lit(True)
    for c in columns:
        aggs.append(F.count_if(passed & F.col(c).isNull()).alias(f"removed_{c}"))
        passed = passed & F.col(c).isNotNull()
    aggs.append(F.count_if(passed).alias("kept_rows"))
    return df.agg(*aggs)


def mutual_coalesce(df: DataFrame, a: str = "name", b: str = "original_name",
                    order: list[str] | None = None) -> DataFrame:
    """``a := coalesce(a, b)`` and ``b := coalesce(b, a)`` from the original
    values (C4), with both columns moved to the end, ``a`` first (C5), or to
    ``order`` when given."""
    rest = [c for c in df.columns if c not in (a, b)]
    out = df.select(*rest,
                    F.coalesce(F.col(a), F.col(b)).alias(a),
                    F.coalesce(F.col(b), F.col(a)).alias(b))
    return out.select(*order) if order else out


def tv_valid_rows(df: DataFrame, key: str = "id", a: str = "name",
                  b: str = "original_name") -> DataFrame:
    """Keep rows with a key and at least one of the two names."""
    return df.filter(F.col(key).isNotNull() & ~(F.col(a).isNull() & F.col(b).isNull()))


def fill_defaults(df: DataFrame, fills: dict) -> DataFrame:
    """Replace nulls by per-column defaults.

    Uses ``na.fill``: a fill for a double column also replaces NaN, and a fill
    naming a column that does not exist raises.
    """
    return df.na.fill(fills)


def empty_arrays(df: DataFrame, arrays: dict) -> DataFrame:
    """Null arrays -> typed empty arrays (C8); elements are left untouched."""
    return df.withColumns({c: or_empty(c, t) for c, t in arrays.items()})


def valid_rows(spec: MediaSpec) -> Column:
    """The row-validity rule of a media type, on the raw columns."""
    if spec.name_pair:
        a, b = spec.name_pair
        return F.col("id").isNotNull() & (F.col(a).isNotNull() | F.col(b).isNotNull())
    return keys_present(spec.required)


def clean(df: DataFrame, spec: MediaSpec) -> DataFrame:
    """The full null handling of one media type, as one projection + filter.

    Movies: key filter, fills, empty arrays, schema order.
    TV: mutual name coalesce, validity filter, fills, empty arrays, silver order.
    Extra columns (a version column, say) are kept after the catalogue columns.
    """
    extra = [c for c in df.columns if c not in spec.columns]
    if spec.name_pair:
        a, b = spec.name_pair
        df = tv_valid_rows(mutual_coalesce(df, a, b), "id", a, b)
    else:
        df = require_keys(df, spec.required)
    df = empty_arrays(fill_defaults(df, spec.fills), spec.arrays)
    return df.select(*spec.silver_order, *extra)


def greatest_rows(df: DataFrame, key: str = "id") -> DataFrame:
    """One row per key: the greatest in column order.

    Plans as partial + final aggregate: duplicates of a hot key collapse
    map-side before the shuffle, so no task receives more than one partial row
    per key and input partition.  Null struct fields order first, so non-null
    values win.
    """
    cols = df.columns
    packed = F.struct(*[F.col(c) for c in cols if c != key])
    return (df.groupBy(key)
            .agg(F.max(packed).alias("_best"))
            .select(*[F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in cols]))


def dedupe_by_id(df: DataFrame, key: str = "id", order: list[str] | tuple = (),
                 source: DataFrame | None = None,
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """One row per key: the greatest row in the order ``(order..., rest...)``.

    ``order`` names version columns (newest slice wins); the remaining columns
    in their schema order break ties, so the survivor is deterministic, unlike
    ``dropDuplicates``.

    With version columns the winners are found on keys and versions alone: two
    narrow aggregates name the keys that occur more than once and the newest
    version of each, and the rows are then filtered in place against that list
    (broadcast behind the size bound, else a shuffled hash join).  Whole rows are
    never sorted, and not shuffled while the list is small.  Only rows that tie
    in key and newest version are compared whole; so are all rows without
    version columns (``greatest_rows``).  ``source`` has the same rows where
    ``df`` must be read once only (it is observed).
    """
    cols, order = df.columns, tuple(order)
    if not order:
        return greatest_rows(df, key)
    source = df if source is None else source
    seen = source.groupBy(key, *order).agg(F.count(F.lit(1)).alias("_ties"))
    newest = seen.groupBy(key).agg(F.max(F.struct(*order, "_ties")).alias("_best"), F.sum("_ties").alias("_rows"))
    version = F.struct(*[F.col(f"_best.{c}").alias(c) for c in order])
    listed, _, size = materialize_table(
        newest.where("_rows > 1").select(F.col(key).alias("_key"), version.alias("_version"), F.col("_best._ties").alias("_ties")),
        "repeated-keys")
    side = F.broadcast(listed) if size <= broadcast_bytes else listed.hint("shuffle_hash")
    won = F.col("_version").eqNullSafe(F.struct(*order))

    def matched(rows: DataFrame, how: str) -> DataFrame:
        return rows.join(side, F.col(key).eqNullSafe(F.col("_key")), how)

    single = matched(df, "left").where(F.col("_ties").isNull() | ((F.col("_ties") == 1) & won)).select(*cols)
    if listed.where("_ties > 1").isEmpty():
        return single
    tied = matched(source, "inner").where((F.col("_ties") > 1) & won).select(*cols)
    return single.unionByName(greatest_rows(tied, key))
