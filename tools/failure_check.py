"""Task failures during the pipelines' write jobs: results and metrics stay exact.

    python tools/failure_check.py <scratch dir>

Runs in its own ``local[4,2]`` session (tasks may fail once and are retried).
A pass-through ``mapInPandas`` stage makes the first attempt of one task fail
mid-write; the snapshot must still hold exactly the expected rows, and the
observed counts must not include the failed attempt.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from reelyard import fixtures as fx  # noqa: E402
from reelyard.plans import pipelines as P  # noqa: E402
from reelyard.plans.queries import silver_movies  # noqa: E402
from reelyard.schemas import MOVIE  # noqa: E402
from reelyard.sinks import snapshot as S  # noqa: E402
from reelyard.sinks.write import sink_bronze  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


def fail_once(marker: str):
    """A pass-through batch function whose first run on partition 0 fails."""
    def run(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        first = ctx.partitionId() == 0 and ctx.attemptNumber() == 0
        for i, batch in enumerate(batches):
            if first and i == 0 and not os.path.exists(marker):
                open(marker, "w").close()
                raise RuntimeError("injected task failure")
            yield batch
    return run


def main() -> None:
    scratch = sys.argv[1]
    spark = (SparkSession.builder.master("local[4,2]").appName("failure-check")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    expected = silver_movies(spark, SMOKE)
    flaky = expected.mapInPandas(fail_once(f"{scratch}/marker-silver"), expected.schema)
    silver = f"{scratch}/silver"
    v1, rows1 = S.write_snapshot(flaky, silver, None)
    same1 = S.read_snapshot(spark, silver).exceptAll(expected).isEmpty() and \
        expected.exceptAll(S.read_snapshot(spark, silver)).isEmpty()

    changes = f"{scratch}/changes"
    sink_bronze(fx.movie_changes(spark, SMOKE), changes)
    base = S.read_snapshot(spark, silver)
    merged, obs, _ = P.merged_frame(base, spark.read.parquet(changes), MOVIE)
    flaky_merge = merged.mapInPandas(fail_once(f"{scratch}/marker-merge"), merged.schema)
    v2, rows2 = S.write_snapshot(flaky_merge, silver, v1)
    got = S.read_snapshot(spark, silver)
    print(json.dumps({
        "silver_rows": rows1, "silver_expected": expected.count(), "silver_same": same1,
        "merge_version": v2, "merge_rows": rows2, "merge_read_back": got.count(),
        "merge_observed": obs[-1].get["rows"], "merge_ids_unique": got.select("id").distinct().count(),
        "failures_injected": sorted(f for f in os.listdir(scratch) if f.startswith("marker")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
