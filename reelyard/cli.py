"""spark-submit entry points, one sub-command per pipeline.

    spark-submit --py-files reelyard.zip reelyard/cli.py silver --media movie \\
        --bronze <bronze root> --silver <silver path>
    python -m reelyard.cli backfill --media tv --landed <pages> --bronze <root>
    python -m reelyard.cli collect  --media movie --change-pages <pages> \\
        --details <details> --today 2024-01-31 [--days 3] --changes <path>
    python -m reelyard.cli apply    --media movie --silver <path> --changes <path>
    python -m reelyard.cli stream   --media movie --landing <dir> --silver <path>
    python -m reelyard.cli vacuum   --silver <path> [--keep 2]

Landed inputs are Parquet tables of responses: pages ``day, page, status,
body`` and details ``id, status, body``.  The session comes from the launcher
(``getOrCreate``), so cluster settings are the caller's; ``--input-bytes``
applies the partition sizing of ``session.scale_settings``.  Each command
prints one JSON line with what it did.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from reelyard.plans import pipelines as P
from reelyard.schemas import CHANGE_PAGE_CAP, SPECS
from reelyard.session import tune_for_input


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="reelyard")
    ap.add_argument("--input-bytes", type=int, default=None,
                    help="size of the input, to size scan splits and shuffles")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def cmd(name: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        p.add_argument("--media", choices=sorted(SPECS), required=True)
        return p

    p = cmd("backfill")
    p.add_argument("--landed", required=True)
    p.add_argument("--bronze", required=True)
    p.add_argument("--dataset", default=None)
    p.add_argument("--years", type=int, nargs=2, default=None, metavar=("FIRST", "LAST"),
                   help="report calendar days of this range with no landed page")

    p = cmd("silver")
    p.add_argument("--bronze", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--files", type=int, default=None)

    p = cmd("collect")
    p.add_argument("--change-pages", required=True)
    p.add_argument("--details", required=True)
    p.add_argument("--today", required=True, help="first day not looked back at (ISO)")
    p.add_argument("--days", type=int, default=None,
                   help="look-back days (default: 3 for movies, 10 for TV)")
    p.add_argument("--changes", required=True)
    p.add_argument("--cap", type=int, default=CHANGE_PAGE_CAP)

    p = cmd("apply")
    p.add_argument("--silver", required=True)
    p.add_argument("--changes", required=True)
    p.add_argument("--files", type=int, default=None)

    p = sub.add_parser("vacuum")
    p.add_argument("--silver", required=True)
    p.add_argument("--keep", type=int, default=2)

    p = cmd("stream")
    p.add_argument("--landing", required=True)
    p.add_argument("--silver", required=True)
    p.add_argument("--checkpoint", default=None)
    p.add_argument("--files", type=int, default=None)
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"reelyard-{args.cmd}").getOrCreate()
    if args.input_bytes:
        tune_for_input(spark, args.input_bytes)
    if args.cmd == "vacuum":
        from reelyard.sinks.snapshot import drop_old_versions

        out = {"command": "vacuum", "removed": drop_old_versions(spark, args.silver, args.keep)}
        print(json.dumps(out))
        return out
    spec = SPECS[args.media]
    if args.cmd == "backfill":
        rep = P.backfill(spark.read.parquet(args.landed), spec, args.bronze, args.dataset,
                         tuple(args.years) if args.years else None)
    elif args.cmd == "silver":
        rep = P.build_silver(spark, args.bronze, spec, args.silver, args.files)
    elif args.cmd == "collect":
        rep = P.collect_changes(spark.read.parquet(args.change_pages),
                                spark.read.parquet(args.details), spec,
                                args.today, args.days or spec.lookback_days, args.changes,
                                args.cap)
    elif args.cmd == "apply":
        rep = P.apply_changes_run(spark, args.silver, args.changes, spec, args.files)
    else:
        from reelyard.streaming.changes import apply_landed_changes

        version = apply_landed_changes(spark, args.landing, args.silver, spec,
                                       args.checkpoint, args.files)
        rep = P.RunReport(version=version)
    out = {"command": args.cmd, "media": args.media, "rows_written": rep.rows_written,
           "version": rep.version, "metrics": rep.metrics}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
