"""The merge of the snapshot at size: rows move once, buckets follow the table's size, hot issues are trimmed."""

from __future__ import annotations

import glob
from datetime import date

from pyspark.sql import functions as F

from echolot.sources import snapshot, tables

SCHEMA = "iid long, state string, updated_at timestamp_ntz"


def versions(spark, ids):
    rows = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "iid long, n int")
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("n"))
    return rows.select("iid", F.concat(F.lit("s"), "n").alias("state"), stamp.alias("updated_at"))


def test_rows_of_a_merge_move_once_and_are_sorted_once(spark):
    rows = versions(spark, [1, 2, 2, 3])
    plan = snapshot._newest(rows, 4, rows)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange hashpartitioning(bucket") == 1 and initial.count("Exchange") == 1
    assert initial.count("Sort [") == 1


def test_a_large_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    table, base = str(tmp_path / "table"), str(tmp_path / "snapshot")
    rows = versions(spark, range(200))
    tables.write_partition(rows, table, date(2026, 1, 1))
    monkeypatch.setattr(snapshot, "BUCKET_BYTES", 300)
    commit = snapshot.merge_snapshot(spark, table, base, rows.schema, buckets=2)
    size = sum(f.bytes for f in map(lambda r: snapshot.LandedFile(*r), snapshot.list_files(spark, table).collect()))
    assert len(commit.buckets) >= size // 400 > 2
    assert all(len(glob.glob(f"{path}/*.parquet")) <= 1 for path in commit.paths(base))
    got = snapshot.read_current(spark, base, rows.schema).select("iid", "state").collect()
    assert sorted((r.iid, r.state) for r in got) == [(i, f"s{i}") for i in range(200)]


def test_issues_with_many_versions_are_cut_first(spark, monkeypatch):
    monkeypatch.setattr(snapshot, "MANY_VERSIONS", 3)
    rows = versions(spark, [1] * 9 + [2, 2, 3] + [None] * 5).repartition(2)
    newest = snapshot._newest(rows, 4, rows)
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()
    assert sorted(((r.iid or 0), r.state) for r in newest.collect()) == [(0, "s16"), (1, "s8"), (2, "s10"), (3, "s11")]
    plain = tables.latest_per_issue(rows).collect()
    assert sorted(map(repr, plain)) == sorted(map(repr, newest.drop("bucket").collect()))
