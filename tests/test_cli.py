"""The spark-submit entry points run the whole catalogue cycle end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelyard import fixtures as fx
from reelyard.cli import main
from reelyard.sinks import snapshot as S
from tests.conftest import SMOKE


def test_backfill_silver_collect_apply(spark, scratch):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                             "spark.sql.files.maxPartitionBytes")}
    try:
        _cycle(spark, scratch)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def _cycle(spark, scratch):
    landed, change_pages, details = scratch("landed"), scratch("cp"), scratch("det")
    fx.discover_movie_pages(spark, SMOKE).write.parquet(landed)
    fx.change_pages(spark, SMOKE).write.parquet(change_pages)
    fx.movie_details(spark, SMOKE).write.parquet(details)
    bronze, silver, changes = scratch("bronze"), scratch("silver"), scratch("changes")

    out = main(["backfill", "--media", "movie", "--landed", landed, "--bronze", bronze], spark)
    assert out["rows_written"] > 0

    out = main(["--input-bytes", "1000000", "silver", "--media", "movie",
                "--bronze", bronze, "--silver", silver], spark)
    assert out["version"] == 1
    assert all(v == 0 for v in out["metrics"]["silver_nulls"].values())

    today = fx.change_pages(spark, SMOKE).agg(F.date_add(F.max(F.to_date("day")), 1)).first()[0]
    out = main(["collect", "--media", "movie", "--change-pages", change_pages, "--details", details,
                "--today", today.isoformat(), "--days", "3", "--changes", changes], spark)
    assert out["rows_written"] > 0
    assert sum(out["metrics"]["days_by_end"].values()) == 3
    assert out["metrics"]["days_not_landed"] == 0

    out = main(["apply", "--media", "movie", "--silver", silver, "--changes", changes], spark)
    assert out["version"] == 2
    ids = S.read_snapshot(spark, silver).select("id")
    assert ids.count() == ids.distinct().count()
