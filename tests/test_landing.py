"""Only unread files are opened, and the result is that of reading all."""

from __future__ import annotations

import json
import os

import pytest
from test_ingest import CFG, DAY1, DAY2, Deployment, row

from echolot.operators.scoring import FAILURES, TooManyFailures, add_scored, scored_results
from echolot.plans.ingest import run_batch
from echolot.sources.landing import literal_path, record_files, unread_files
from echolot.sources.pages import read_issue_pages
from echolot.sources.run_state import load_run_state
from echolot.sources.tables import load_issues


@pytest.fixture
def site(spark, tmp_path):
    return Deployment(spark, tmp_path)


@pytest.fixture
def manifest(tmp_path):
    return str(tmp_path / "manifest")


def names(files):
    return [os.path.basename(file.path) for file in files]


def test_one_new_of_a_thousand_pages_is_read(spark, site, manifest):
    for i in range(1000):
        site.land(f"old{i:04}", row(100 + i, 1))
    first = site.run(DAY1, manifest=manifest)
    assert (first.files, first.fetched, first.new) == (1000, 1000, 1000)
    site.land("new", row(5000, 2), row(5001, 3))
    unread = unread_files(spark, str(site.landing), manifest)
    pages = read_issue_pages(spark, [literal_path(file.path) for file in unread])
    assert names(unread) == ["new.json"] and len(pages.inputFiles()) == 1
    second = site.run(DAY2, manifest=manifest)
    assert (second.files, second.fetched, second.new, second.saved) == (1, 2, 2, 2)
    third = site.run(DAY2, manifest=manifest)
    assert (third.files, third.fetched, third.new) == (0, 0, 0)


def test_equal_to_the_full_read_night_by_night(spark, tmp_path):
    sites = []
    for name in ("full", "manifest"):
        root = tmp_path / name
        root.mkdir()
        sites.append(Deployment(spark, root))
    full, short = sites
    nights = [
        {"a": [row(20, 1), row(21, 2)], "b": [row(22, 2)]},
        {"c": [row(23, 3), row(21, 2)]},
        {},
        {"late": [row(24, 1), row(25, 5)], "empty": []},
    ]
    for day, pages in zip((DAY1, DAY1, DAY2, DAY2), nights, strict=True):
        for name, rows in pages.items():
            for site in sites:
                site.land(name, *rows)
                if name == "late":  # an old time of modification does not hide it
                    os.utime(site.landing / "late.json", (1_000_000, 1_000_000))
        a = full.run(day)
        b = short.run(day, manifest=str(tmp_path / "files"))
        assert (a.new, a.prepared, a.saved, a.state) == (b.new, b.prepared, b.saved, b.state)
    assert full.rows() == short.rows()
    rows = [sorted(map(str, load_issues(spark, site.table).collect())) for site in sites]
    assert rows[0] == rows[1]


def test_a_rewritten_file_is_read_again(spark, site, manifest):
    site.land("1", row(20, 1))
    site.land("2[a]{b}*", row(21, 1))
    record_files(spark, unread_files(spark, str(site.landing), manifest), manifest)
    assert unread_files(spark, str(site.landing), manifest) == []
    site.land("1", row(20, 1), row(22, 4))
    assert names(unread_files(spark, str(site.landing), manifest)) == ["1.json"]
    odd = read_issue_pages(spark, [literal_path(str(site.landing / "2[a]{b}*.json"))])
    assert [r.iid for r in odd.collect()] == [21]


def test_a_run_that_fails_reads_its_files_again(spark, site, manifest):
    site.land("1", row(20, 1))

    def broken(df, cfg):
        raise ValueError("no model")

    with pytest.raises(ValueError, match="no model"):
        site.run(DAY1, manifest=manifest, enricher=broken)
    run = site.run(DAY1, manifest=manifest)
    assert (run.files, run.new) == (1, 1)
    assert unread_files(spark, str(site.landing) + "/none", manifest) == []
    with pytest.raises(ValueError, match="parity"):
        site.run(DAY1, manifest=manifest, parity=True)


def _enricher(bad):
    """Scores by a scorer that fails on some texts, and labels and organisations of none."""

    def make():
        def score(rows):
            if any(bad(text) for (text,) in rows):
                raise RuntimeError("no answer")
            return [0.5 for _ in rows]

        return score

    def enrich(df, cfg):
        results = scored_results("desc_clean", make_scorer=make, returns="double", default=0.0)
        scored = add_scored(df, "sentiment", results)
        return scored.selectExpr("*", "array('EU') AS labels_v1", "'x' AS org")

    return enrich


def test_failed_scorer_calls_are_counted_and_bounded(spark, site):
    site.land("1", *[row(100 + i, 1, description=f"text {i}") for i in range(1000)])
    with pytest.raises(TooManyFailures, match="1000 scorer calls failed"):
        site.run(DAY1, enricher=_enricher(lambda text: True), max_failed_share=0.01)
    assert not os.path.exists(site.table) and not os.path.exists(site.state)
    run = site.run(DAY1, enricher=_enricher(lambda text: text == "text 7"), max_failed_share=0.01)
    assert (run.failed, run.saved) == (1, 1000)
    issues = load_issues(spark, site.table)
    assert FAILURES not in issues.columns
    assert [(r.iid, r.sentiment) for r in issues.where("sentiment <> 0.5").collect()] == [(107, 0.0)]
    assert load_run_state(spark, site.state).last_fetched_issues == 1000


def test_scorer_errors_are_told(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "iid long, t string")

    def make():
        def score(rows):
            return [1 / (text != "b") for (text,) in rows]

        return score

    results = scored_results("t", make_scorer=make, returns="double", default=-1.0, skip_null=True)
    got = {r.iid: (r.s, r[FAILURES]) for r in add_scored(df, "s", results).collect()}
    assert got == {1: (1.0, 0), 2: (-1.0, 1), 3: (None, 0)}
    errors = {r.iid: r.e for r in df.select("iid", results["error"].alias("e")).collect()}
    assert errors == {1: None, 2: "ZeroDivisionError: division by zero", 3: None}


def test_settings_of_the_job(tmp_path):
    from ingest_job import arguments

    path = tmp_path / "cfg.json"
    path.write_text(json.dumps({"lexicon": {"gut": 2}, "label_rules": [["EU", "low code"]], "label_version": 2}))
    args = arguments(["--landing", "l", "--table", "t", "--state", "s", "--config", str(path), "--manifest", "m"])
    assert args.config.lexicon == {"gut": 2} and args.config.label_rules == (("EU", "low code"),)
    assert args.config.label_column == "labels_v2" and args.manifest == "m"
    assert run_batch and CFG
