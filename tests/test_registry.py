"""The registered queries against SQL in a second engine."""

from __future__ import annotations

import os
import subprocess
import sys

import oracle
import pytest

import __spark_entry__ as entry
from echolot.plans.catalog import QUERIES as CATALOG

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert oracle.compare(spark, duck, name, QUERIES[name], SQL[name], SF) is None


def test_every_query_of_the_reference_has_its_sql():
    assert set(CATALOG) <= set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "mean_sentiment"]
    assert df.count() > 0


def test_tasks_need_no_installed_package(tmp_path):
    """Python tasks of a session that was started elsewhere find all they need."""
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.abspath(entry.__file__))!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("pluggable_scorer", "read_issue_pages"):
    print("rows", entry.queries()[name](spark, {SF!r}).count())
    entry.queries()[name](spark, {SF!r}).write.format("noop").mode("overwrite").save()
"""
    )
    env = {key: value for key, value in os.environ.items() if key != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300, check=False,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("rows") == 2
