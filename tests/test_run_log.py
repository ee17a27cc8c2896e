"""Two-step publication: a run counts as a whole from its commit on."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

import pytest
from test_ingest import CFG, DAY1, DAY2, Deployment, row

from echolot.plans import ingest
from echolot.schemas import ISSUE_SCHEMA
from echolot.sources import run_log as log
from echolot.sources.tables import load_issues


class LoggedDeployment(Deployment):
    def __init__(self, spark, root):
        super().__init__(spark, root)
        self.log = str(root / "log")

    def run(self, day, **options):
        return super().run(day, run_log=self.log, **options)

    def rows(self):
        rows = log.load_committed(self.spark, self.table, self.log).collect()
        return sorted((r.iid, str(r.processing_date)) for r in rows)

    def runs(self):
        return log.committed_runs(self.spark, self.log)


@pytest.fixture
def site(spark, tmp_path):
    return LoggedDeployment(spark, tmp_path)


def fails(*_, **__):
    raise OSError("lost")


def test_state_rows_and_schema(spark, site):
    assert site.rows() == [] and site.runs() == []
    site.land("1", row(20, 1), row(21, 2))
    run = site.run(DAY1)
    assert (run.new, run.saved) == (2, 2)
    site.land("2", row(22, 3))
    assert site.run(DAY2).new == 1
    assert site.rows() == [(20, str(DAY1)), (21, str(DAY1)), (22, str(DAY2))]
    assert [r.number for r in site.runs()] == [1, 2]
    assert site.runs()[0].state == run.state
    df = log.load_committed(spark, site.table, site.log)
    assert set(df.columns) == {*ISSUE_SCHEMA.fieldNames(), "processing_date"}


def test_a_run_that_fails_between_the_two_steps_leaves_nothing_visible(spark, site, monkeypatch, tmp_path):
    site.land("1", row(20, 1))
    site.run(DAY1, manifest="log", keys_path="log")
    before = (site.rows(), site.runs())
    site.land("2", row(21, 2))
    with monkeypatch.context() as patch:
        patch.setattr(log, "commit_run", fails)
        with pytest.raises(OSError):
            site.run(DAY2, manifest="log", keys_path="log")
    assert (site.rows(), site.runs()) == before
    done = site.run(DAY2, manifest="log", keys_path="log")
    assert (done.files, done.new, done.saved) == (1, 1, 1)
    assert site.ids() == [20, 21]
    assert log.remove_uncommitted(spark, site.table, site.log, datetime(2020, 1, 1)) == []
    later = datetime.now(UTC).replace(tzinfo=None) + timedelta(days=1)
    assert len(log.remove_uncommitted(spark, site.table, site.log, later)) == 1
    assert site.ids() == [20, 21]


def test_of_two_runs_at_once_one_counts(site, monkeypatch):
    site.land("1", row(20, 1))
    real = log.write_run

    def another_run_first(issues, table, run):
        with monkeypatch.context() as patch:
            patch.setattr(log, "write_run", real)
            site.run(DAY1, manifest="log")
        real(issues, table, run)

    with monkeypatch.context() as patch:
        patch.setattr(log, "write_run", another_run_first)
        with pytest.raises(log.RunConflict):
            site.run(DAY1, manifest="log")
    assert site.rows() == [(20, str(DAY1))] and len(site.runs()) == 1
    idle = site.run(DAY2, manifest="log")
    assert (idle.files, idle.new) == (0, 0) and len(site.runs()) == 1


def test_replacing_a_day_switches_with_the_commit(spark, site, monkeypatch):
    site.land("1", row(20, 1))
    site.run(DAY1)
    site.land("2", row(21, 2))
    old = log.load_committed(spark, site.table, site.log)
    with monkeypatch.context() as patch:
        patch.setattr(log, "commit_run", fails)
        with pytest.raises(OSError):
            site.run(DAY1, mode="overwrite")
    assert site.ids() == [20]
    site.run(DAY1, mode="overwrite")
    assert site.ids() == [21]
    assert [r.iid for r in old.collect()] == [20]  # a reader keeps the runs it began with
    site.land("3", row(22, 3))
    site.run(DAY1)
    assert site.ids() == [21, 22]


def test_a_repeated_append_adds_nothing_and_keys_own_texts(spark, site):
    site.land("1", row(20, 1))
    site.run(DAY1, keys_path="log")
    copy = {**row(20, 2), "iid": 21}
    site.land("2", copy, row(22, 3))
    assert site.run(DAY2, keys_path="log").saved == 1
    assert site.ids() == [20, 22]


def test_files_without_new_issues_are_remembered(site):
    site.land("1", row(20, 1))
    site.run(DAY1, manifest="log")
    site.land("2", row(20, 1))
    assert site.run(DAY2, manifest="log").files == 1
    run = site.run(DAY2, manifest="log")
    assert (run.files, run.fetched) == (0, 0)
    assert [(r.number, r.rows) for r in site.runs()] == [(1, True), (2, False)]
    assert site.runs()[1].state == site.runs()[0].state


def test_equal_to_a_run_without_a_log(spark, site, tmp_path):
    site.land("1", *[row(20 + i, i) for i in range(6)])
    site.run(DAY1)
    plain = str(tmp_path / "plain")
    ingest.run_batch(spark, str(site.landing), plain, site.state, DAY1, CFG)
    one = log.load_committed(spark, site.table, site.log)
    other = load_issues(spark, plain)
    assert one.exceptAll(other.select(one.columns)).isEmpty() and one.count() == other.count() == 6
