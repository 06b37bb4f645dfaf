"""Partition sizing and the shared scratch folder."""

from __future__ import annotations

import pytest

from reelyard.session import MB, scale_settings, scratch_path, shared_dir

TB = 1024 ** 4


def test_shuffle_width_follows_input_within_bounds():
    small = scale_settings(10 * MB, slots=8)
    assert small["spark.sql.shuffle.partitions"] == "16"           # two waves of tasks
    mid = scale_settings(1 * TB, slots=400)
    assert mid["spark.sql.shuffle.partitions"] == str(2048)        # ~512 MB per reducer
    huge = scale_settings(100 * TB, slots=4000)
    assert huge["spark.sql.shuffle.partitions"] == str(204800)     # still ~512 MB each
    assert scale_settings(100 * TB, 4000, most_reducers=100_000)["spark.sql.shuffle.partitions"] == "100000"
    assert huge["spark.sql.files.maxPartitionBytes"] == str(256 * MB)
    assert huge["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_scratch_without_a_shared_folder_is_a_clear_error():
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf = {}
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_scratch_lives_under_the_session_checkpoint_dir(spark):
    root = shared_dir(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/x-")
