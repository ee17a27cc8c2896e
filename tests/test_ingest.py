from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from test_cleaning import raw_row

from echolot.config import FORM_PREFIX, IngestConfig, IssueFilter
from echolot.operators.cleaning import postprocess_issues
from echolot.operators.enrichment import enrich
from echolot.plans.dashboard import current_issues, dashboard, facets, publish_snapshot
from echolot.plans.ingest import run_batch
from echolot.schemas import ISSUE_SCHEMA
from echolot.sources.run_state import RunState, load_run_state, save_run_state
from echolot.sources.tables import load_issues
from echolot.streaming.incremental import run_stream

CFG = IngestConfig(lexicon={"gut": 1}, label_rules=(("EU", "europa"),))
DAY1, DAY2 = date(2026, 1, 17), date(2026, 1, 18)


class Deployment:
    """Landing folder, table, state and keys of one test."""

    def __init__(self, spark, root):
        self.spark, self.landing = spark, root / "landing"
        self.landing.mkdir()
        self.table, self.state, self.keys, self.checkpoint = (
            str(root / name) for name in ("table", "state", "keys", "checkpoint")
        )

    def land(self, name, *rows):
        (self.landing / f"{name}.json").write_text(json.dumps(list(rows)), encoding="utf-8")

    def run(self, day, **options):
        cfg = options.pop("cfg", CFG)
        return run_batch(
            self.spark, str(self.landing), self.table, self.state, day, cfg, **options
        )

    def stream(self, day, **options):
        run_stream(
            self.spark, str(self.landing), self.table, self.checkpoint, day, CFG, **options
        ).awaitTermination()

    def rows(self):
        return sorted((r.iid, str(r.processing_date)) for r in load_issues(self.spark, self.table).collect())

    def ids(self):
        return [iid for iid, _ in self.rows()]


@pytest.fixture
def site(spark, tmp_path):
    return Deployment(spark, tmp_path)


def row(iid, hour, **fields):
    fields = {"description": f"text {iid}", **fields}
    return raw_row(iid, f"title {iid}", created=f"2026-01-10T{hour:02}:00:00.5Z", **fields)


def test_first_run_counts_and_state(spark, site):
    site.land(
        "1",
        row(1, 0),
        row(20, 1),
        row(21, 2, description="Test"),
        raw_row(22, f"{FORM_PREFIX} /wtf", created="2026-01-10T03:00:00Z"),
        row(23, 4, description="gut für Europa, sagt die Beispiel GmbH"),
        raw_row(24, created="2025-12-31T23:59:59Z"),
    )
    run = site.run(DAY1)
    assert (run.fetched, run.new, run.prepared, run.saved) == (6, 5, 3, 2)
    want = RunState(datetime(2026, 1, 10, 4, 0, 0, 500000), 5, 2)
    assert run.state == want == load_run_state(spark, site.state)
    assert site.ids() == [20, 23]
    issue = load_issues(spark, site.table).filter("iid = 23").first()
    assert (issue.sentiment, issue.labels_v1, issue.org, issue.feedback_round) == (
        1.0, ["EU"], "Beispiel GmbH", 2,
    )


def test_written_partition_has_the_issue_schema(spark, site):
    site.land("1", row(20, 1))
    site.run(DAY1)
    part = spark.read.parquet(f"{site.table}/processing_date={DAY1}")
    got = [(f.name, f.dataType) for f in part.schema.fields]
    assert got == [(f.name, f.dataType) for f in ISSUE_SCHEMA.fields]


def test_second_run_takes_only_new_issues(site):
    site.land("1", row(20, 1), row(21, 2))
    site.run(DAY1)
    site.land("2", row(21, 2), row(22, 3))
    run = site.run(DAY2)
    assert (run.fetched, run.new, run.saved) == (4, 1, 1)
    assert site.rows() == [(20, str(DAY1)), (21, str(DAY1)), (22, str(DAY2))]
    idle = site.run(DAY2)
    assert (idle.new, idle.saved) == (0, 0)
    assert site.ids() == [20, 21, 22]


def test_two_runs_equal_one_run(spark, site, tmp_path):
    rows = [row(20 + i, i) for i in range(8)]
    site.land("1", *rows[:4])
    site.run(DAY1)
    site.land("2", *rows[4:])
    site.run(DAY2)
    (tmp_path / "whole").mkdir()
    whole = Deployment(spark, tmp_path / "whole")
    whole.land("1", *rows)
    whole.run(DAY1)
    both = current_issues(spark, site.table).drop("processing_date")
    once = current_issues(spark, whole.table).drop("processing_date")
    assert both.exceptAll(once).isEmpty() and once.exceptAll(both).isEmpty()
    assert both.count() == 8


def test_watermark_of_excluded_rows(site):
    """An excluded newest row is not read again, except in parity mode."""
    site.land("1", row(20, 1), row(21, 5, description="Test"))
    assert site.run(DAY1).state.last_successful_run.hour == 5
    assert site.run(DAY2).new == 0


def test_watermark_in_parity_mode(spark, site):
    site.land("1", row(20, 1), row(21, 5, description="Test"))
    assert site.run(DAY1, parity=True).state.last_successful_run.hour == 1
    run = site.run(DAY2, parity=True)
    assert (run.new, run.saved) == (1, 0)
    assert load_run_state(spark, site.state) == RunState(None, 1, 0)


def test_same_day_keeps_earlier_runs_or_overwrites(site):
    site.land("1", row(20, 1))
    site.run(DAY1)
    site.land("2", row(21, 2))
    assert site.run(DAY1).saved == 1
    assert site.ids() == [20, 21]
    site.land("3", row(22, 3))
    site.run(DAY1, mode="overwrite")
    assert site.ids() == [22]


def test_streams_of_two_checkpoints_keep_each_other(site, tmp_path):
    site.land("1", row(20, 1))
    site.stream(DAY1)
    site.landing, site.checkpoint = tmp_path / "other", str(tmp_path / "second")
    site.landing.mkdir()
    site.land("1", row(21, 2))
    site.stream(DAY1)
    assert site.ids() == [20, 21]


def test_repeated_append_adds_nothing(site, spark):
    site.land("1", row(20, 1), row(21, 2))
    state = load_run_state(spark, site.state)
    site.run(DAY1)
    save_run_state(spark, site.state, state)  # as if the run had ended before it saved its state
    site.run(DAY1)
    assert site.ids() == [20, 21]


def test_history_keeps_updates_of_the_owner(site):
    cfg = IngestConfig(watermark_column="updated_at")
    site.land("1", row(20, 1))
    site.run(DAY1, cfg=cfg, keys_path=site.keys)
    site.land("2", {**row(20, 1), "state": "closed", "updated_at": "2026-02-01T00:00:00.000Z"})
    run = site.run(DAY1, cfg=cfg, keys_path=site.keys)
    assert (run.new, run.saved) == (1, 1)


def test_history_is_optional(site):
    site.land("1", row(20, 1))
    site.run(DAY1, keys_path=site.keys)
    copy = {**row(20, 5), "iid": 30}
    site.land("2", copy, row(31, 6))
    run = site.run(DAY2, keys_path=site.keys)
    assert (run.new, run.saved) == (2, 1)
    assert site.ids() == [20, 31]


def test_failed_run_keeps_the_state_and_can_be_repeated(spark, site):
    site.land("1", row(20, 1))
    site.run(DAY1)
    before = load_run_state(spark, site.state)
    site.land("2", row(21, 2))

    def failing(df, cfg):
        from pyspark.sql import functions as F

        return enrich(df, cfg).withColumn("org", F.raise_error(F.lit("model is down")))

    with pytest.raises(Exception, match="model is down"):
        site.run(DAY2, enricher=failing)
    assert load_run_state(spark, site.state) == before
    assert site.run(DAY2).saved == 1
    assert site.ids() == [20, 21]


def test_updates_arrive_with_the_other_watermark(spark, site):
    cfg = IngestConfig(watermark_column="updated_at")
    args = (spark, str(site.landing), site.table, site.state)
    site.land("1", row(20, 1, updated_at="2026-01-11T00:00:00Z"))
    run_batch(*args, DAY1, cfg)
    site.land("2", row(20, 1, state="closed", updated_at="2026-01-12T00:00:00Z"))
    assert run_batch(*args, DAY2, cfg).new == 1
    assert [(r.iid, r.state) for r in current_issues(spark, site.table).collect()] == [(20, "closed")]


def test_stream_reads_each_file_once(spark, site):
    site.land("1", row(20, 1), row(21, 2))
    site.stream(DAY1)
    assert site.ids() == [20, 21]
    site.stream(DAY1)
    assert site.ids() == [20, 21]
    site.land("2", row(22, 3), row(23, 4, description="Test"))
    site.stream(DAY2)
    assert site.rows() == [(20, str(DAY1)), (21, str(DAY1)), (22, str(DAY2))]


def test_stream_keeps_batches_of_a_day_and_drops_known_issues(site):
    site.land("1", row(20, 1))
    site.stream(DAY1, keys_path=site.keys)
    site.land("2", {**row(20, 5), "iid": 30}, row(31, 6))
    site.stream(DAY1, keys_path=site.keys)
    assert site.ids() == [20, 31]


def test_stream_applies_a_watermark(site):
    site.land("1", row(20, 1), row(21, 2))
    site.stream(DAY1, watermark=datetime(2026, 1, 10, 1, 0, 0, 500000))
    assert site.ids() == [21]


def test_dashboard_frames(spark, site, tmp_path):
    site.land(
        "1",
        row(20, 1, description="gut"),
        row(21, 2, description="Europa"),
        row(22, 3, description="ohne"),
    )
    site.run(DAY1)
    issues = publish_snapshot(spark, site.table, str(tmp_path / "snapshot"))
    frames = dashboard(issues, IssueFilter(search="g|e"), seed=1)
    assert {name: frame.count() for name, frame in frames.items()} == {
        "sample": 1, "overview": 1, "per_day": 1, "labels": 2, "form": 1,
        "sentiment_by_label": 2, "sentiment_by_page": 1, "authors": 1, "orgs": 1,
    }
    assert frames["overview"].first().n_issues == 3
    assert [r.label for r in facets(issues)["labels"].collect()] == ["EU", "Unklar"]


def test_other_label_versions_stand_beside(spark):
    cfg = IngestConfig(label_version=2)
    df = spark.createDataFrame(
        [(1, "/a/", ["x"], [])],
        "iid long, form_page string, labels_v1 array<string>, labels_v2 array<string>",
    )
    got = postprocess_issues(df, cfg).first()
    assert (got.labels_v1, got.labels_v2, got.form_page) == (["x"], ["Unklar"], "/a")


def test_job(spark, site, monkeypatch):
    import ingest_job

    kept = {key: spark.conf.get(key) for key in ingest_job.cluster_conf(0)}
    site.land("1", row(20, 1))
    argv = ["--landing", str(site.landing), "--table", site.table, "--state", site.state]
    try:
        assert ingest_job.main([*argv, "--date", "2026-01-17"]) == 0
        assert site.rows() == [(20, "2026-01-17")]
        site.land("2", row(21, 2, created_at="yesterday"))
        assert ingest_job.main(argv) == 1
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
