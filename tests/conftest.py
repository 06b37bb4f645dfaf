from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelyard.session import local_session

    s = local_session(cores=4, shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reelyard-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from reelyard.session import scratch_path

    return lambda name="t": scratch_path(spark, name)


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
