"""Day ranges: islands of consecutive days and interval overlap joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bins double from level to level; 2**20 days are 2,870 years.
MAX_LEVEL = 20


def day_ranges(days: DataFrame, day: str = "day", keys: tuple[str, ...] = ()) -> DataFrame:
    """Gaps and islands: each run of consecutive days as ``first_day, last_day, days``.

    Repeated days count once, null days not at all.  Runs are Spark sessions with
    a gap of one day, merged on both sides of the shuffle.
    """
    at = F.to_timestamp(F.to_date(F.col(day)))
    found = days.select(*keys, at.alias("_at")).where(F.col("_at").isNotNull()).distinct()
    runs = found.groupBy(*keys, F.session_window("_at", "1 day").alias("_run")).agg(F.count(F.lit(1)).alias("days"))
    return runs.select(*keys, F.to_date("_run.start").alias("first_day"),
                       F.date_sub(F.to_date("_run.end"), 1).alias("last_day"), "days")


def _day_number(day: str) -> Column:
    return F.datediff(F.col(day), F.lit("1970-01-01").cast("date")).cast("long")


def _binned(df: DataFrame, side: str, start: str, end: str, top: int) -> DataFrame:
    """A row for each bin that an interval touches, at its own level and above.

    An interval's own level is the smallest whose bins (``2**level`` days) are not
    shorter than it; there and above it touches two bins at most.
    """
    lo, hi = _day_number(start), _day_number(end)
    level = F.ceil(F.log2((hi - lo + 1).cast("double"))).cast("int")
    rows = df.where(F.col(start) <= F.col(end)).select(
        F.struct(*df.columns).alias(side), lo.alias("_lo"), hi.alias("_hi"), level.alias("_own"))
    rows = rows.select("*", F.explode(F.sequence("_own", F.lit(top))).alias("_level"))
    first, last = F.expr("shiftright(_lo, _level)"), F.expr("shiftright(_hi, _level)")
    rows = rows.select("*", first.alias("_first"), F.explode(F.sequence(first, last)).alias("_bin"))
    return rows.select(side, "_level", "_bin", F.col("_lo").alias(f"_{side}_lo"), F.col("_hi").alias(f"_{side}_hi"),
                       F.col("_first").alias(f"_{side}_first"), (F.col("_own") == F.col("_level")).alias(f"_{side}_own"))


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str],
                 right_range: tuple[str, str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Every pair of a left and a right interval with a day in common: the columns of both.

    Ranges are closed day intervals ``(first, last)``; ranges with a null end or
    that end before they begin match nothing.  ``keys`` are columns of both that
    must be equal (they come once).

    A pair meets at the level of its longer interval, in the first bin that both
    touch, so it is found once, by an equi-join.  Bins there are at most twice as
    long as that interval: what is compared without overlapping stays in
    proportion to the neighbours of the longer interval, whatever the mix of
    short and long ones, and no side is compared with all of the other.  Skewed
    bins are split by adaptive execution (a plain sort-merge join).
    """
    clash = (set(left.columns) & set(right.columns)) - set(keys)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    # No interval of either side is longer than the bins of the highest level used: two numbers.
    longest = [df.agg(F.max(F.datediff(F.col(e), F.col(s)))).first()[0] or 0
               for df, (s, e) in ((left, left_range), (right, right_range))]
    top = min(MAX_LEVEL, max(0, max(longest)).bit_length())
    a = _binned(left, "left", *left_range, top)
    b = _binned(right, "right", *right_range, top)
    same = (F.col("a._level") == F.col("b._level")) & (F.col("a._bin") == F.col("b._bin"))
    for k in keys:
        same &= F.col(f"left.{k}") == F.col(f"right.{k}")
    pairs = a.alias("a").join(b.alias("b"), same & (F.col("_left_own") | F.col("_right_own"))
                              & (F.col("_left_lo") <= F.col("_right_hi")) & (F.col("_right_lo") <= F.col("_left_hi"))
                              & (F.col("a._bin") == F.greatest("_left_first", "_right_first")))
    return pairs.select("left.*", *[F.col(f"right.{c}") for c in right.columns if c not in keys])
