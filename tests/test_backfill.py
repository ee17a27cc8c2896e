"""Back-fill of the round in partitions that were written before it existed."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from echolot.operators.cleaning import feedback_round
from echolot.sources.backfill import backfill, partitions_without
from echolot.sources.tables import load_issues, write_partition

OLD, NEW = date(2025, 12, 31), date(2026, 1, 17)


def issues(spark, ids, **extra):
    rows = spark.createDataFrame([(i, f"202{5 + i % 2}-12-30 10:00:00" if i else None) for i in ids], "iid long, at string")
    rows = rows.select("iid", F.col("at").cast("timestamp_ntz").alias("created_at"))
    return rows.withColumns({name: F.lit(value) for name, value in extra.items()})


def files(table):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(table)
        for name in names
        if name.endswith(".parquet")
    }


@pytest.fixture
def table(spark, tmp_path):
    base = str(tmp_path / "table")
    write_partition(issues(spark, range(6)), base, OLD)
    write_partition(issues(spark, range(6, 9), org="O"), base, OLD.replace(day=30))
    write_partition(feedback_round(issues(spark, range(10, 14))), base, NEW)
    return base


def test_old_partitions_get_the_round_and_others_keep_their_files(spark, table):
    before = files(table)
    assert len(partitions_without(spark, table, "feedback_round")) == 2
    done = backfill(spark, table, "feedback_round", feedback_round)
    assert [f.rsplit("=", 1)[1] for f in done] == ["2025-12-30", "2025-12-31"]
    got = {(r.iid, r.feedback_round, str(r.processing_date)) for r in load_issues(spark, table).collect()}
    assert got == {
        (i, (2 if i % 2 else 1) if i else None, str(day))  # an issue without a date has no round
        for ids, day in ((range(6), OLD), (range(6, 9), OLD.replace(day=30)), (range(10, 14), NEW))
        for i in ids
    }
    assert {r.org for r in load_issues(spark, table).filter("iid = 7").collect()} == {"O"}
    after = files(table)
    kept = {path for path in before if str(NEW) in path}
    assert kept and all(after[path] == before[path] for path in kept)
    assert not backfill(spark, table, "feedback_round", feedback_round) and files(table) == after


def test_partitions_of_micro_batches(spark, tmp_path):
    base = str(tmp_path / "table")
    write_partition(issues(spark, [1, 2]), base, OLD, batch=4)
    write_partition(feedback_round(issues(spark, [3])), base, OLD, batch=5)
    done = backfill(spark, base, "feedback_round", feedback_round)
    assert len(done) == 1 and done[0].endswith("ingest_batch=4")
    rows = spark.read.option("mergeSchema", "true").parquet(base).collect()
    assert {(r.iid, r.feedback_round, r.ingest_batch) for r in rows} == {(1, 2, 4), (2, 1, 4), (3, 2, 5)}


def test_a_failed_fill_leaves_the_table(spark, table):
    before = files(table)
    broken = lambda df: df.withColumn("feedback_round", F.raise_error(F.lit("no")).cast("byte"))
    with pytest.raises(Exception):
        backfill(spark, table, "feedback_round", broken)
    with pytest.raises(ValueError):
        backfill(spark, table, "feedback_round", lambda df: df)
    assert files(table) == before


def test_no_table(spark, tmp_path):
    assert backfill(spark, str(tmp_path / "none"), "feedback_round", feedback_round) == []
