from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from echolot.config import FIRST_WATERMARK
from echolot.operators.quality import schema_diff
from echolot.schemas import ISSUE_SCHEMA, RAW_SCHEMA
from echolot.session import cluster_conf, scratch_path
from echolot.sources import tables
from echolot.sources.pages import read_issue_pages, write_issue_pages
from echolot.sources.run_state import RunState, load_run_state, save_run_state
from echolot.sources.vocabulary import load_label_vocab

OLD, NEW = date(2025, 12, 31), date(2026, 1, 17)


def issue(iid):
    return {"iid": iid, "title": f"t{iid}", "closed_at": None, "author": {"id": 1, "name": "a"},
            "unknown": {"more": 1}}


def ids(df):
    return sorted(row.iid for row in df.select("iid").collect())


def test_pages_one_per_file(spark, tmp_path):
    for name, page in {"1": [issue(1), issue(2)], "2": [issue(3)], "3": []}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(page, indent=2), encoding="utf-8")
    df = read_issue_pages(spark, str(tmp_path), one_page_per_file=True)
    assert df.schema == RAW_SCHEMA
    assert ids(df) == [1, 2, 3]
    inferred = read_issue_pages(spark, str(tmp_path), one_page_per_file=True, schema=None)
    assert "unknown" in inferred.columns


def test_pages_one_per_line(spark, tmp_path):
    lines = [json.dumps([issue(1), issue(2)]), "[]", json.dumps([issue(3)])]
    (tmp_path / "pages.json").write_text("\n".join(lines), encoding="utf-8")
    assert ids(read_issue_pages(spark, str(tmp_path))) == [1, 2, 3]


def test_broken_pages_fail(spark, tmp_path):
    (tmp_path / "pages.json").write_text('[{"iid": 1}]\n[{"iid": ', encoding="utf-8")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_issue_pages(spark, str(tmp_path)).collect()


def test_written_pages_are_bounded(spark, tmp_path):
    rows = spark.range(1050).selectExpr("id AS iid", "'x' AS title").repartition(3)
    path = str(tmp_path / "pages")
    write_issue_pages(rows, path, page_size=100)
    sizes = [len(json.loads(row.value)) for row in spark.read.text(path).collect()]
    assert sum(sizes) == 1050 and max(sizes) <= 100
    assert ids(read_issue_pages(spark, path)) == list(range(1050))


def test_rerun_replaces_its_partition_only(spark, tmp_path):
    base = str(tmp_path / "t")
    tables.write_partition(spark.createDataFrame([(1,)], "iid long"), base, OLD)
    tables.write_partition(spark.createDataFrame([(2,)], "iid long"), base, NEW)
    tables.write_partition(spark.createDataFrame([(3,)], "iid long"), base, NEW)
    assert ids(tables.load_issues(spark, base)) == [1, 3]
    tables.write_partition(spark.createDataFrame([(4,)], "iid long"), base, NEW, mode="append")
    assert ids(tables.load_issues(spark, base)) == [1, 3, 4]


def test_load_fills_missing_columns_and_skips_corrupt_files_on_demand(spark, tmp_path):
    base = tmp_path / "t"
    old = spark.createDataFrame([(1, "a"), (2, "b")], "iid long, org string")
    new = spark.createDataFrame([(2, "c", 2), (3, "d", 2)],
                                "iid long, org string, feedback_round tinyint")
    tables.write_partition(old, str(base), OLD)
    tables.write_partition(new, str(base), NEW)
    bad = base / f"processing_date={NEW}" / "bad.parquet"
    bad.write_bytes(b"this is no parquet file")
    want = [(1, "a", None, OLD), (2, "b", None, OLD), (2, "c", 2, NEW), (3, "d", 2, NEW)]
    for schema in (None, new.schema):
        df = tables.load_issues(spark, str(base), schema, skip_corrupt=True)
        assert df.columns == ["feedback_round", "iid", "org", "processing_date"]
        got = [(r.iid, r.org, r.feedback_round, r.processing_date) for r in df.collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    with pytest.raises(Exception, match="FAILED_READ_FILE|CANNOT_READ"):
        tables.load_issues(spark, str(base), new.schema).collect()
    latest = tables.latest_per_issue(tables.load_issues(spark, str(base), skip_corrupt=True), order=["processing_date"])
    assert {r.iid: r.org for r in latest.collect()} == {1: "a", 2: "c", 3: "d"}
    diff = schema_diff(*(spark.read.parquet(f"{base}/processing_date={d}/part*") for d in (OLD, NEW)))
    assert [r.column for r in diff.collect() if not r.in_old] == ["feedback_round"]


def test_missing_table_is_empty(spark, tmp_path):
    df = tables.load_issues(spark, str(tmp_path / "none"))
    assert df.isEmpty()
    assert set(df.columns) == {*ISSUE_SCHEMA.fieldNames(), "processing_date"}


def test_union_aligned(spark):
    a = spark.createDataFrame([(1, "x")], "b long, z string")
    b = spark.createDataFrame([(2, True)], "b long, a boolean")
    union = tables.union_aligned([a, b])
    assert union.columns == ["a", "b", "z"]
    assert sorted(map(tuple, union.collect()), key=str) == [(None, 1, "x"), (True, 2, None)]


def test_latest_version_by_date_then_update(spark):
    rows = [
        (1, "2025-12-31", "2026-05-01", "old"),
        (1, "2026-01-17", None, "unknown"),
        (1, "2026-01-17", "2026-01-02", "newest"),
        (2, None, "2026-01-01", "undated"),
        (2, "2025-12-31", "2025-01-01", "dated"),
    ]
    df = spark.createDataFrame(rows, "iid long, processing_date string, updated_at string, v string")
    got = {row.iid: row.v for row in tables.latest_per_issue(df).collect()}
    assert got == {1: "newest", 2: "dated"}


def test_vocabulary_file(spark, tmp_path):
    path = tmp_path / "labels.txt"
    path.write_text("# list\nEU\n\n  Low Code\t\n   # no\n\xa0Daten\n", encoding="utf-8")
    assert [row.label for row in load_label_vocab(spark, str(path)).collect()] == [
        "EU", "Low Code", "Daten",
    ]


def test_state_absent_saved_and_damaged(spark, tmp_path):
    path = str(tmp_path / "state")
    assert load_run_state(spark, path) == RunState(FIRST_WATERMARK)
    first = RunState(datetime(2026, 1, 17, 9, 29, 7, 80000), 12, 11)
    save_run_state(spark, path, first)
    assert load_run_state(spark, path) == first
    second = RunState(None, 3, 0)
    save_run_state(spark, path, second)
    assert load_run_state(spark, path) == second
    damaged = tmp_path / "damaged.json"
    damaged.write_text("{nonsense", encoding="utf-8")
    assert load_run_state(spark, str(damaged)) == RunState(None)


def test_state_in_the_published_form(spark, tmp_path):
    path = tmp_path / "state.json"
    state = {
        "last_successful_run": "2026-01-17T09:29:07.080000Z",
        "last_fetched_issues": 12,
        "total_issues_processed": 11,
    }
    path.write_text(json.dumps(state, indent=2), encoding="utf-8")
    want = RunState(datetime(2026, 1, 17, 9, 29, 7, 80000), 12, 11)
    assert load_run_state(spark, str(path)) == want


def test_scratch_paths_are_new_and_shared(spark):
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert base is None or all(path.startswith(base) for path in paths)


def test_cluster_conf_scales_with_the_input():
    assert cluster_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert int(cluster_conf(100 * 10**12)["spark.sql.shuffle.partitions"]) > 700_000
