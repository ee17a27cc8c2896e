"""Figures from partial aggregates against the figures of the whole table."""

from __future__ import annotations

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from echolot.plans import figures
from echolot.plans.dashboard import all_figures, publish_snapshot, read_snapshot
from echolot.schemas import ISSUE_SCHEMA
from echolot.sources.snapshot import current_commit, expire
from echolot.sources.tables import write_partition

DAYS = [date(2026, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "snapshot")


def issue(iid, **fields):
    row = {f.name: None for f in ISSUE_SCHEMA.fields} | {
        "iid": iid,
        "created_at": datetime(2026, 1, 1 + iid % 5, 23, 59, 59),
        "author_id": None if iid % 7 == 0 else iid % 11,
        "author_name": None if iid % 7 == 0 else f"a{iid % 3}",
        "is_from_form": iid % 2 == 0,
        "form_page": "/x" if iid % 3 else None,
        "sentiment": None if iid % 13 == 0 else iid % 8 / 8,
        "labels_v1": [["EU", "Daten"], [], None, ["EU", "EU"]][iid % 4],
        "org": "O",
    }
    return tuple((row | fields)[f.name] for f in ISSUE_SCHEMA.fields)


def publish(spark, place, day, rows):
    write_partition(spark.createDataFrame(rows, ISSUE_SCHEMA), place[0], day)
    publish_snapshot(spark, *place, buckets=8)
    return figures.refresh_figures(spark, place[1], ISSUE_SCHEMA)


def check(spark, place):
    want = all_figures(read_snapshot(spark, place[1]))
    got = figures.dashboard_figures(spark, place[1])
    assert set(want) == set(got)
    for name, frame in got.items():
        assert frame.dtypes == want[name].dtypes, name
        assert [tuple(r) for r in frame.collect()] == [tuple(r) for r in want[name].collect()], name


def test_all_figures_after_new_and_edited_issues(spark, place):
    assert publish(spark, place, DAYS[0], [issue(i) for i in range(200)]) == [0]
    check(spark, place)
    edits = [issue(i, sentiment=-1.0, org="P", labels_v1=["Neu"], author_id=500) for i in (3, 7)]
    assert publish(spark, place, DAYS[1], [*edits, issue(1000)]) == [1]
    check(spark, place)
    assert figures.refresh_figures(spark, place[1], ISSUE_SCHEMA) == []


def test_only_written_buckets_are_counted(spark, place, tmp_path):
    publish(spark, place, DAYS[0], [issue(i) for i in range(200)])
    publish(spark, place, DAYS[1], [issue(3, sentiment=0.5)])
    new = spark.read.parquet(f"{place[1]}/figures/version=1")
    touched = [k for k, v in enumerate(current_commit(spark, place[1]).buckets) if v == 1]
    assert [r.bucket for r in new.select("bucket").distinct().collect()] == touched and len(touched) == 1
    # No file of issues is read for the figures.
    files = figures.read_figures(spark, place[1]).inputFiles()
    assert files and all("/figures/" in f for f in files)


def test_figures_that_were_not_finished_are_counted_again(spark, place):
    publish(spark, place, DAYS[0], [issue(i) for i in range(20)])
    os.unlink(f"{place[1]}/figures/version=0/_SUCCESS")
    assert figures.refresh_figures(spark, place[1], ISSUE_SCHEMA) == [0]
    check(spark, place)


def test_replaced_partition_and_expiry(spark, place):
    publish(spark, place, DAYS[0], [issue(i) for i in range(50)])
    publish(spark, place, DAYS[0], [issue(i) for i in range(30)])
    check(spark, place)
    expire(spark, place[1], keep=1)
    assert not os.path.exists(f"{place[1]}/figures/version=0")
    check(spark, place)


def test_empty_table(spark, place):
    assert figures.refresh_figures(spark, place[1], ISSUE_SCHEMA) == []
    assert [tuple(r) for r in figures.overview(figures.read_figures(spark, place[1])).collect()] == [(0, None, 0)]
    check_empty = figures.dashboard_figures(spark, place[1])
    assert all(frame.count() == 0 for name, frame in check_empty.items() if name != "overview")


def test_sketched_authors_are_near_the_exact_number(spark, tmp_path):
    rows = spark.range(60_000).select(
        (F.col("id") % 8).cast("int").alias("bucket"),
        *[
            {"author_id": F.col("id") % 20_000, "labels_v1": F.array(F.lit("EU"))}
            .get(f.name, F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in ISSUE_SCHEMA.fields
        ],
    )
    partials = figures.partial_figures(rows, "bucket")
    exact = figures.overview(partials).first()
    near = figures.overview(partials, approximate=True).first()
    assert (exact.n_issues, exact.n_authors) == (60_000, 20_000) and near.n_issues == 60_000
    assert abs(near.n_authors - 20_000) < 20_000 * 0.05


def test_a_value_of_a_third_of_the_rows_moves_once_per_task(spark):
    rows = spark.createDataFrame([issue(i) for i in range(40)], ISSUE_SCHEMA).withColumn("bucket", F.lit(0))
    plan = figures.partial_figures(rows, "bucket")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
