"""De-duplication of a stream by state."""

from __future__ import annotations

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from echolot.config import EXCLUDED_IIDS, IngestConfig
from echolot.operators.enrichment import enrich
from echolot.sources.tables import load_issues
from echolot.streaming.incremental import run_stream

CFG = IngestConfig(lexicon={"gut": 1}, label_rules=(("EU", "europa"),))
DAY = date(2026, 1, 17)


class Site:
    def __init__(self, spark, root):
        self.spark, self.landing = spark, root / "landing"
        self.landing.mkdir()
        self.table, self.checkpoint = str(root / "table"), str(root / "checkpoint")

    def land(self, name, *rows):
        (self.landing / f"{name}.json").write_text(json.dumps(list(rows)), encoding="utf-8")

    def stream(self, **options):
        run_stream(
            self.spark, str(self.landing), self.table, self.checkpoint, DAY, CFG,
            dedupe_by_state=True, **options,
        ).awaitTermination()

    def rows(self):
        if not os.path.exists(self.table):
            return []
        rows = load_issues(self.spark, self.table).select("iid", "state", "sentiment", "labels_v1", "org")
        return sorted((tuple(r) for r in rows.collect()), key=repr)

    def ids(self):
        return [r[0] for r in self.rows()]


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def row(iid, text, hour=1, updated="2026-01-11T00:00:00Z", **fields):
    return {
        "iid": iid, "title": f"title {text}", "description": text, "state": "opened",
        "created_at": f"2026-01-10T{hour:02}:00:00.5Z", "updated_at": updated, "closed_at": None,
        "author": {"id": 1, "name": "A", "state": "active"}, "user_notes_count": 0, "upvotes": 0,
        "downvotes": 0, "references": {"short": None, "relative": None, "full": "g#1"},
    } | fields


def test_a_text_belongs_to_the_issue_that_brought_it_first(site):
    site.land("1", row(105, "gut in Europa", 3), row(106, "gut in Europa", 4), row(107, "other"))
    site.stream()
    assert site.ids() == [105, 107]
    # Earlier created, but landed later: the owner stays. A new text comes in.
    site.land("2", row(101, "gut in Europa", 1), row(108, "new"))
    site.stream()
    assert site.ids() == [105, 107, 108]
    assert site.rows()[0][2:] == (1.0, ["EU"], "Unklar")


def test_later_versions_of_the_owner_stay_and_repeated_ones_go(site):
    site.land("1", row(105, "a"))
    site.stream()
    site.land("2", row(105, "a"), row(101, "a"))
    site.stream()
    assert site.ids() == [105]
    # In one batch with an earlier copy of another issue.
    site.land("3", row(101, "a", 0), row(105, "a", updated="2026-01-12T00:00:00Z", state="closed"))
    site.stream()
    assert [(r[0], r[1]) for r in site.rows()] == [(105, "closed"), (105, "opened")]


def test_nulls_and_rows_that_own_nothing(site):
    excluded = row(EXCLUDED_IIDS[0], "shared")
    none = row(None, "no number"), row(None, "no number", 2)
    bare = row(130, "x", title=None), row(131, "x", title=None)
    old = row(132, "old", created_at="2025-01-01T00:00:00Z")
    site.land("1", excluded, *none, old, row(140, "undated", updated=None))
    site.stream(watermark=datetime(2026, 1, 1))
    site.land("2", row(120, "shared"), row(150, "no number"), row(133, "old"), row(141, "undated"), *bare)
    site.stream(watermark=datetime(2026, 1, 1))
    # An issue without number is excluded as ever, so it owns nothing either.
    assert set(site.ids()) >= {120, 133, 140, 150} and not {141, 131, None} & set(site.ids())


def test_a_failed_batch_is_repeated_from_the_state_before_it(site):
    for n in range(4):
        site.land(n, row(10 + n, f"text {n}"), row(20 + n, "text 0"))
    calls = []

    def failing(df, cfg):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return enrich(df, cfg)

    with pytest.raises(Exception):
        site.stream(max_files_per_trigger=1, enricher=failing)
    site.stream(max_files_per_trigger=1)
    texts = load_issues(site.spark, site.table).select("description").collect()
    assert sorted(r.description for r in texts) == [f"text {n}" for n in range(4)]


def test_a_hot_text_and_an_empty_landing(site, spark):
    site.land("0")
    site.land("1", *[row(n, "same" if n % 3 else f"text {n}", n % 20) for n in range(900, 1500)])
    site.stream()
    rows = load_issues(spark, site.table)
    assert rows.count() == 201 and rows.filter(F.col("description") == "same").first().iid == 920


def test_two_ways_at_once_are_refused(site):
    with pytest.raises(ValueError):
        site.stream(keys_path="keys")
