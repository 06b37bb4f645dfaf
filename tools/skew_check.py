"""Dedupe with one hot key: partial-aggregate plan vs a row_number window.

    python tools/skew_check.py [sf_dir]

A third of ``lineitem`` rows get the same key.  Both plans keep the greatest
row per key; the window plan must sort every row of the hot key in one task,
the aggregate collapses it map-side first.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reelyard.operators.clean import dedupe_by_id  # noqa: E402
from reelyard.session import local_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    skewed = li.withColumn("k", F.when(F.col("l_orderkey") % 3 == 0, F.lit(0))
                           .otherwise(F.col("l_orderkey")))
    cols = [c for c in skewed.columns if c != "k"]
    w = Window.partitionBy("k").orderBy(*[F.col(c).desc() for c in cols])
    plans = {
        "aggregate": lambda: dedupe_by_id(skewed, "k"),
        "window": lambda: skewed.withColumn("_rn", F.row_number().over(w))
                                .where("_rn = 1").drop("_rn"),
    }
    out = {}
    for name, build in plans.items():
        best = None
        for _ in range(3):
            t0 = time.perf_counter()
            build().write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = round(best, 3)
    same = dedupe_by_id(skewed, "k").exceptAll(plans["window"]()).isEmpty()
    hot = skewed.where("k = 0").count()
    print({"rows": skewed.count(), "hot_key_rows": hot, "seconds": out, "same_result": same})


if __name__ == "__main__":
    main()
