"""Bytes read and shuffled per pipeline, from Spark's event log.

    python tools/stage_report.py [sf_dir]

Runs the silver build (both de-duplication strategies) and the change merge
with the event log written to a fresh folder under /tmp, then sums, per
pipeline, the records read by all scans and the shuffle bytes written, from the
task-end events.  It shows where the data moves: the merge should shuffle only
the change set, the split silver build only the repeated ids.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from reelyard import fixtures as fx  # noqa: E402
from reelyard.plans import pipelines as P  # noqa: E402
from reelyard.plans.queries import _write_slices, silver_movies  # noqa: E402
from reelyard.schemas import MOVIE  # noqa: E402
from reelyard.session import scratch_path  # noqa: E402
from reelyard.sinks import snapshot as S  # noqa: E402
from reelyard.sinks.write import sink_bronze  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="reelyard-eventlog-")
    spark = (SparkSession.builder.master("local[8]").appName("stage-report")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext

    root = _write_slices(spark, fx.bronze_movies(spark, sf), MOVIE, fx.movie_changes(spark, sf))
    snap = scratch_path(spark, "report-silver")
    S.write_snapshot(silver_movies(spark, sf), snap, None)
    changes = scratch_path(spark, "report-changes")
    sink_bronze(fx.movie_changes(spark, sf), changes)

    runs = {
        "silver build": lambda: P.build_silver(spark, root, MOVIE, scratch_path(spark, "r1")),
        "change merge": lambda: P.apply_changes_run(spark, snap, changes, MOVIE),
    }
    for name, fn in runs.items():
        sc.setJobGroup(name, name)
        fn()
    sc.setJobGroup("", "")
    spark.stop()

    job_group, stage_job = {}, {}
    totals = defaultdict(lambda: defaultdict(int))
    for path in sorted(glob.glob(f"{log_dir}/**/*", recursive=True)):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    job_group[ev["Job ID"]] = group
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerTaskEnd":
                    group = job_group.get(stage_job.get(ev.get("Stage ID")))
                    m = ev.get("Task Metrics") or {}
                    if group not in runs:
                        continue
                    totals[group]["input_records"] += \
                        (m.get("Input Metrics") or {}).get("Records Read", 0)
                    totals[group]["shuffle_write_bytes"] += \
                        (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    totals[group]["tasks"] += 1
    silver_bytes = sum(os.path.getsize(f) for f in glob.glob(f"{snap}/version=00000001/*/*.parquet"))
    change_bytes = sum(os.path.getsize(f) for f in glob.glob(f"{changes}/*.parquet"))
    print(json.dumps({"silver_file_bytes": silver_bytes, "change_file_bytes": change_bytes,
                      "pipelines": {k: dict(v) for k, v in totals.items()}}, indent=1))


if __name__ == "__main__":
    main()
