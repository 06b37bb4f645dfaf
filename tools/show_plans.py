"""Print the physical plans of the core pipelines (``explain()`` output).

    python tools/show_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelyard import fixtures as fx  # noqa: E402
from reelyard.operators import ingest as I  # noqa: E402
from reelyard.plans import pipelines as P  # noqa: E402
from reelyard.plans.queries import _write_slices, silver_movies  # noqa: E402
from reelyard.schemas import CHANGE_ITEM, MOVIE  # noqa: E402
from reelyard.session import local_session, scratch_path  # noqa: E402
from reelyard.sinks.write import sink_bronze  # noqa: E402
from reelyard.sources.records import typed_pages  # noqa: E402
from reelyard.sources.scan import scan_glob  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    silver = scratch_path(spark, "plan-silver")
    silver_movies(spark, sf).write.parquet(silver)
    changes = scratch_path(spark, "plan-changes")
    sink_bronze(fx.movie_changes(spark, sf), changes)

    root = _write_slices(spark, fx.bronze_movies(spark, sf), MOVIE, fx.movie_changes(spark, sf))
    raw = scan_glob(spark, root, MOVIE.bronze_prefix, slice_column="_slice")
    print("### silver build (P3): clean + dedupe by id\n")
    P.silver_frame(raw, MOVIE, ("_slice",)).explain()

    merged, _, _ = P.merged_frame(spark.read.parquet(silver), spark.read.parquet(changes), MOVIE)
    print("### change merge (P6): anti join + union\n")
    merged.explain()

    pages = I.stored_pages(typed_pages(fx.change_pages(spark, sf), CHANGE_ITEM))
    print("### change-list walk (I4): per-day cut table\n")
    I.page_cuts(pages, False, 500).explain()
    print("### change-list walk (I4): pages filtered by the broadcast cuts\n")
    I.changed_pages(pages).explain()
    spark.stop()


if __name__ == "__main__":
    main()
