"""De-duplication at a larger size: winners found on keys and versions, against whole-row aggregate and window.

    python tools/dedupe_strategy_check.py [sf_dir] [copies]

Each document of ``documents`` is expanded into ``copies`` catalogue rows with
distinct ids (``explode(sequence(...))``, no join); every tenth id comes again
with a newer title.  All plans write the same rows; prints their times.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from reelyard.operators.clean import dedupe_by_id, greatest_rows  # noqa: E402
from reelyard.schemas import MOVIE  # noqa: E402
from reelyard.session import local_session, scratch_path  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 40
    spark = local_session(shuffle_partitions=64)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    n_docs = docs.count()
    rows = docs.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c")).select(
        (F.col("c") * n_docs + F.col("doc_id")).cast("int").alias("id"),
        F.col("source").alias("title"), F.col("text").alias("overview"),
        F.lit("2020-01-01").alias("release_date"), F.col("n_chars").cast("string").alias("vote_average"),
        F.array((F.col("doc_id") % 5).cast("int")).alias("genre_ids"))
    path = scratch_path(spark, "big-bronze")
    newer = rows.where(F.col("id") % 10 == 0).withColumn("title", F.concat("title", F.lit("_v2")))
    rows.withColumn("v", F.lit(0)).unionByName(newer.withColumn("v", F.lit(1))).repartition(64).write.parquet(path)

    def window(df):
        w = Window.partitionBy("id").orderBy(*[F.col(c).desc() for c in ("v", *MOVIE.columns[1:])])
        return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

    def aggregate(df):
        return greatest_rows(df.select("id", "v", *MOVIE.columns[1:])).select(*df.columns)

    plans = {"winners": lambda df: dedupe_by_id(df, "id", ("v",)), "aggregate": aggregate, "window": window,
             "winners, shuffled": lambda df: dedupe_by_id(df, "id", ("v",), broadcast_bytes=0)}
    out, written = {}, {}
    for name in [*plans, *plans]:
        target = scratch_path(spark, f"big-{name}")
        t0 = time.perf_counter()
        plans[name](spark.read.parquet(path)).write.parquet(target)
        dt = time.perf_counter() - t0
        out[name] = round(min(dt, out.get(name, dt)), 2)
        written[name] = spark.read.parquet(target)
    same = all(written["window"].exceptAll(w.select(*written["window"].columns)).isEmpty() for w in written.values())
    print(json.dumps({"rows": n_docs * copies, "seconds": out, "same_result": same}))


if __name__ == "__main__":
    main()
