"""Versioned datasets: write beside what is read, verify, switch.

The reference reads silver, caches it and overwrites the same path; without
the cache (or after losing an executor that held it) the job deletes its own
input.  Here every replacement is a folder of its own, read back after the
write, and becomes current by an empty marker file:

    <path>/version=00000002/part-*.parquet
    <path>/version=00000002/_verified

The highest marked version is the current one.  Creating the marker is the only
switch, so a crash at any point leaves the previous version current, whole and
readable, and the next run writes the unmarked folder anew.  A dataset has one
writer at a time; concurrent commits are the business of a table format.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from reelyard.sinks.write import BLOCK_SIZE, delete_path, path_exists, sink_silver

log = logging.getLogger(__name__)

MARKER = "_verified"


class StaleBase(RuntimeError):
    """The new rows were made from a version that is not the current one."""


class SnapshotVerificationError(RuntimeError):
    """The written version does not hold the rows that were written."""


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version:08d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Verified versions, ascending (``drop_old_versions`` keeps the list short)."""
    if not path_exists(spark, path):
        return []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
    numbers = sorted(int(n[8:]) for n in names if n.startswith("version="))
    return [v for v in numbers if path_exists(spark, f"{version_path(path, v)}/{MARKER}")]


def current_version(spark: SparkSession, path: str) -> int | None:
    """The highest verified version, or None for a dataset never written."""
    return max(versions(spark, path), default=None)


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A verified version (default: the current one) as a DataFrame."""
    there = versions(spark, path)
    if version is None and there:
        version = there[-1]
    if version not in there:
        raise FileNotFoundError(f"no verified version {version or ''} at {path}")
    return spark.read.parquet(version_path(path, version))


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a versioned dataset, or a plain Parquet folder."""
    if current_version(spark, path) is not None:
        return read_snapshot(spark, path)
    return spark.read.parquet(path)


def _switch(spark: SparkSession, path: str, version: int) -> None:
    """Make a written and verified version the current one."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{version_path(path, version)}/{MARKER}")
    marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(marker)


def _write_version(df: DataFrame, path: str, version: int, files: int | None,
                   block_size: int) -> int:
    """Write and read back one version without making it current; its rows."""
    target = version_path(path, version)
    written = sink_silver(df, target, files, block_size)
    found = df.sparkSession.read.parquet(target).count()  # from the files' footers
    if found != written:
        raise SnapshotVerificationError(f"{target}: wrote {written} rows, read back {found}")
    return found


def write_snapshot(df: DataFrame, path: str, base_version: int | None = None,
                   files: int | None = None, block_size: int = BLOCK_SIZE) -> tuple[int, int]:
    """Write ``df`` as the next version, verify it, switch to it.

    ``base_version`` is the version the caller read ``df`` from (None for the
    first write).  Returns ``(version, rows)``.
    """
    spark = df.sparkSession
    if (now := current_version(spark, path)) != base_version:
        raise StaleBase(f"{path}: the current version is {now}, the rows come from {base_version}")
    new = (base_version or 0) + 1
    rows = _write_version(df, path, new, files, block_size)
    _switch(spark, path, new)
    return new, rows


def sink_if_nonempty(df: DataFrame, path: str) -> int:
    """Replace the dataset only when there is at least one row (W3); returns rows.

    The rows are written once, as the next version, and counted on the way.
    Without rows that folder goes and the current version stays; the previous
    version is removed only after the switch, so a change set that was there
    before is never lost.
    """
    spark = df.sparkSession
    now = current_version(spark, path)
    new = (now or 0) + 1
    rows = _write_version(df, path, new, None, BLOCK_SIZE)
    if rows == 0:
        log.warning("no rows to write to %s; previous data left in place", path)
        delete_path(spark, version_path(path, new))
        return 0
    _switch(spark, path, new)
    drop_old_versions(spark, path)
    return rows


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` verified versions; returns those removed.

    Readers pin a version when they start, so keep at least 2 while jobs may
    still read the previous one.
    """
    if keep < 1:
        raise ValueError("keep at least the current version")
    old = versions(spark, path)[:-keep]
    for v in old:
        delete_path(spark, version_path(path, v))
    return old
