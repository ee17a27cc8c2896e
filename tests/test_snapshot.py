"""The versioned snapshot against the newest versions of the whole table."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from echolot.sources import tables
from echolot.sources.snapshot import current_commit, expire, merge_snapshot, read_current
from echolot.sources.tables import latest_per_issue, write_partition

DAYS = [date(2026, 1, d) for d in (1, 2, 3)]
SCHEMA = "iid long, state string, updated_at timestamp_ntz"
BUCKETS = 16


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "table"), str(tmp_path / "snapshot")


def versions(spark, ids, state, hour):
    rows = spark.createDataFrame([(i,) for i in ids], "iid long")
    stamp = F.lit(f"2026-01-01 {hour:02}:00:00").cast("timestamp_ntz")
    return rows.select("iid", F.lit(state).alias("state"), stamp.alias("updated_at"))


def merge(spark, place):
    return merge_snapshot(spark, *place, versions(spark, [1], "", 0).schema, BUCKETS)


def shown(spark, place):
    df = read_current(spark, place[1], versions(spark, [1], "", 0).schema)
    return sorted(((r.iid, r.state, str(r.updated_at), str(r.processing_date)) for r in df.collect()), key=repr)


def newest(spark, place):
    df = latest_per_issue(tables.load_issues(spark, place[0]))
    return sorted(((r.iid, r.state, str(r.updated_at), str(r.processing_date)) for r in df.collect()), key=repr)


def bucket_folders(base, version):
    return sorted(os.listdir(f"{base}/data/version={version}")) if os.path.exists(f"{base}/data/version={version}") else []


def test_only_touched_buckets_are_written(spark, place):
    write_partition(versions(spark, range(2000), "opened", 1), place[0], DAYS[0])
    first = merge(spark, place)
    assert first.version == 0 and set(first.buckets) == {0}
    write_partition(versions(spark, [7, 5000], "closed", 2), place[0], DAYS[1])
    second = merge(spark, place)
    touched = [k for k, v in enumerate(second.buckets) if v == 1]
    assert 1 <= len(touched) <= 2
    assert [f for f in bucket_folders(place[1], 1) if f.startswith("bucket")] == sorted(f"bucket={k}" for k in touched)
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{place[1]}/data/version=1") for f in fs)
    whole = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{place[1]}/data/version=0") for f in fs)
    assert size < whole / 4
    assert shown(spark, place) == newest(spark, place)
    assert merge(spark, place) == second  # nothing new, nothing written


def test_a_reader_keeps_its_version(spark, place):
    write_partition(versions(spark, range(100), "opened", 1), place[0], DAYS[0])
    merge(spark, place)
    before = read_current(spark, place[1], versions(spark, [1], "", 0).schema)
    write_partition(versions(spark, range(50), "closed", 2), place[0], DAYS[1])
    merge(spark, place)
    assert {r.state for r in before.collect()} == {"opened"} and before.count() == 100
    assert shown(spark, place) == newest(spark, place)


def test_a_merge_that_failed_before_its_commit_is_repeated(spark, place, monkeypatch):
    write_partition(versions(spark, range(100), "opened", 1), place[0], DAYS[0])
    merge(spark, place)
    old = shown(spark, place)
    write_partition(versions(spark, range(50), "closed", 2), place[0], DAYS[1])

    def lost(*args):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr("echolot.sources.snapshot.create_file", lost)
        with pytest.raises(OSError, match="lost"):
            merge(spark, place)
    assert shown(spark, place) == old
    merge(spark, place)
    assert shown(spark, place) == newest(spark, place) != old


def test_a_replaced_partition_builds_the_snapshot_anew(spark, place):
    write_partition(versions(spark, range(100), "opened", 1), place[0], DAYS[0])
    write_partition(versions(spark, range(60), "closed", 2), place[0], DAYS[1])
    merge(spark, place)
    write_partition(versions(spark, range(10), "closed", 3), place[0], DAYS[1])
    merge(spark, place)
    assert shown(spark, place) == newest(spark, place)
    assert sum(row[1] == "closed" for row in shown(spark, place)) == 10
    write_partition(versions(spark, [500], "opened", 3), place[0], DAYS[2])
    merge(spark, place)
    assert shown(spark, place) == newest(spark, place)


def test_batches_decide_ties_and_old_buckets_expire(spark, place):
    for batch, state in ((1, "first"), (3, "third"), (2, "second")):
        write_partition(versions(spark, range(20), state, 1), place[0], DAYS[0], batch=batch)
        merge(spark, place)
    assert {row[1] for row in shown(spark, place)} == {"third"}
    again = read_current(spark, place[1], versions(spark, [1], "", 0).schema)
    assert {r.ingest_batch for r in again.collect()} == {3}
    assert expire(spark, place[1], keep=1) > 0
    assert {row[1] for row in shown(spark, place)} == {"third"}
    assert current_commit(spark, place[1]).version == 2


def test_empty_table_null_numbers_and_equal_versions(spark, place):
    assert shown(spark, place) == []
    merge(spark, place)
    assert shown(spark, place) == []
    rows = versions(spark, [None, None, 1], "opened", 1).unionByName(versions(spark, [1], "closed", 1))
    write_partition(rows, place[0], DAYS[0])
    merge(spark, place)
    assert shown(spark, place) == newest(spark, place)
    assert len(shown(spark, place)) == 2


def test_two_merges_at_once_cannot_both_commit(spark, place, monkeypatch):
    write_partition(versions(spark, range(10), "opened", 1), place[0], DAYS[0])
    merge(spark, place)
    write_partition(versions(spark, range(10), "closed", 2), place[0], DAYS[1])
    from echolot.session import create_file

    create_file(spark, f"{place[1]}/commits/00000001.json", '{"version": 1, "buckets": []}')
    monkeypatch.setattr("echolot.sources.snapshot.current_commit", lambda spark, base: current_commit_of(0))

    def current_commit_of(version):
        from echolot.sources.snapshot import Commit

        return Commit(version, (0,) * BUCKETS)

    with pytest.raises(Exception, match="exists"):
        merge(spark, place)
