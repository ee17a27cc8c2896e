from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from echolot.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, memory="4g", app="echolot-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Apply a Column function to a list of values."""

    def apply(values, fn, kind="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i long, v {kind}").coalesce(1)
        return [row.out for row in df.orderBy("i").select(fn(df["v"]).alias("out")).collect()]

    return apply
