from __future__ import annotations

from datetime import date, datetime

import pytest

from echolot.config import IssueFilter
from echolot.operators import facets, metrics, predicates, quality
from echolot.sources.vocabulary import vocabulary_frame

SCHEMA = """iid long, title string, desc_clean string, form_page string, is_from_form boolean,
 author_id long, author_name string, org string, sentiment double, labels_v1 array<string>,
 feedback_round tinyint, created_at timestamp_ntz"""
DAY = datetime(2026, 1, 1, 12)
ROWS = [
    (1, "a", "axb", "home", True, 1, "Ada", "X", -1.0, None, 1, DAY),
    (2, "b", "a.b", "/p", True, 1, "Ada", "X", 1.0, [], 1, DAY.replace(hour=23)),
    (3, "c", "ÄÖ und (mehr", "/p", False, 2, "Bo", "Y", None, ["EU"], 2, DAY.replace(day=3)),
    (4, "d", "kein Raum", None, False, None, None, "X", 0.125, ["EU", "EU"], None, DAY),
    (5, "e", "Ende", "/q", None, 2, "Bo", "Unklar", 0.5, ["Daten", "EU"], 2, DAY),
]


@pytest.fixture(scope="module")
def issues(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


def ids(df):
    return sorted(row.iid for row in df.collect())


def table(df):
    return [tuple(row) for row in df.collect()]


def test_label_filter_needs_all_labels(issues):
    def matching(*labels):
        return ids(issues.filter(predicates.label_filter(labels)))

    assert matching() == [1, 2, 3, 4, 5]
    assert matching("EU") == [3, 4, 5]
    assert matching("EU", "Daten") == [5]
    assert matching("EU", "Daten", "fehlt") == []


def test_set_filters(issues):
    assert ids(issues.filter(predicates.page_filter(["home", "/q"]))) == [1, 5]
    assert ids(issues.filter(predicates.author_filter(["Bo"]))) == [3, 5]
    assert ids(issues.filter(predicates.org_filter(["Y"]))) == [3]
    assert ids(issues.filter(predicates.round_filter([1, 2]))) == [1, 2, 3, 5]
    assert ids(issues.filter(predicates.round_filter([]))) == [1, 2, 3, 4, 5]


def test_sentiment_range_is_closed_and_drops_null(issues):
    assert ids(issues.filter(predicates.sentiment_filter())) == [1, 2, 4, 5]
    assert ids(issues.filter(predicates.sentiment_filter(-1.0, 0.125))) == [1, 4]


def test_search_is_an_expression_unless_literal(issues):
    def found(term, literal=False):
        return ids(issues.filter(predicates.search_filter(term, literal)))

    assert found("A.B") == [1, 2]
    assert found("A.B", literal=True) == [2]
    assert found("äö") == [3]
    assert found("ÄÖ") == [3]
    assert found(r"\S") == [3, 4]  # lower-cased to white space
    assert found("(", literal=True) == [3]
    assert found("") == [1, 2, 3, 4, 5]
    with pytest.raises(Exception, match="PATTERN|PatternSyntaxException"):
        found("(")


def test_all_filters_together(issues):
    f = IssueFilter(labels=("EU",), pages=("/q",), authors=("Bo",), orgs=("Unklar",), rounds=(2,),
                    search="end")
    assert ids(predicates.filtered_issues(issues, f)) == [5]
    assert ids(predicates.filtered_issues(issues, IssueFilter())) == [1, 2, 4, 5]


def test_facets(issues):
    assert table(facets.facet(issues, "labels_v1", explode=True, name="label")) == [
        ("Daten",), ("EU",),
    ]
    assert table(facets.facet(issues, "form_page")) == [("/p",), ("/q",), ("home",)]
    assert table(facets.facet(issues, "feedback_round")) == [(1,), (2,)]


def test_sample(issues):
    assert issues.count() == 5
    assert facets.sample_issues(issues, 1).count() == 1
    assert facets.sample_issues(issues, 9).count() == 5
    first = ids(facets.sample_issues(issues, 3, seed=7))
    assert first == ids(facets.sample_issues(issues.repartition(3), 3, seed=7))
    seen = {tuple(ids(facets.sample_issues(issues, 1, seed=seed))) for seed in range(12)}
    assert len(seen) > 1


def test_cards(issues):
    cards = {row.iid: (row.labels, row.sentiment) for row in facets.issue_cards(issues).collect()}
    assert cards == {
        1: ("None", "-1.00"),
        2: ("None", "1.00"),
        3: ("EU", None),
        4: ("EU, EU", "0.12"),
        5: ("Daten, EU", "0.50"),
    }


def test_overview(issues):
    assert table(metrics.overview_metrics(issues)) == [(5, 0.15625, 3)]
    assert table(metrics.overview_metrics(issues, approximate=True)) == [(5, 0.15625, 3)]
    assert table(metrics.overview_metrics(issues.filter("iid < 0"))) == [(0, None, 0)]


def test_days_without_issues_are_absent(issues):
    assert table(metrics.issues_per_day(issues)) == [(date(2026, 1, 1), 4), (date(2026, 1, 3), 1)]


def test_counts(issues):
    assert table(metrics.count_by(issues, "labels_v1", explode=True, name="label")) == [
        ("EU", 4), (None, 2), ("Daten", 1),
    ]
    assert table(metrics.count_by(issues, "is_from_form")) == [(False, 2), (True, 2), (None, 1)]
    assert table(metrics.count_by(issues, "org")) == [("X", 3), ("Unklar", 1), ("Y", 1)]


def test_exploded_rows_are_kept(issues):
    counted = metrics.count_by(issues, "labels_v1", explode=True, name="label").collect()
    assert sum(row.n_issues for row in counted) == sum(max(1, len(row[9] or [])) for row in ROWS)


def test_mean_sentiment_order(issues):
    only_null = issues.filter("iid in (2, 3, 5)")
    assert table(metrics.mean_sentiment_by(only_null, "org")) == [
        ("Y", None), ("X", 1.0), ("Unklar", 0.5),
    ]
    assert table(metrics.mean_sentiment_by(only_null, "org", nulls_first=False)) == [
        ("X", 1.0), ("Unklar", 0.5), ("Y", None),
    ]
    assert table(metrics.mean_sentiment_by(issues, "labels_v1", explode=True, name="label")) == [
        ("Daten", 0.5), ("EU", 0.25), (None, 0.0),
    ]


def test_captions(issues):
    captioned = facets.with_captions(metrics.count_by(issues, "author_name"))
    assert captioned.columns == ["Autor*in", "Anzahl Issues"]


def test_label_quality(spark, issues):
    assert sorted(table(quality.assigned_labels(issues))) == [("Daten",), ("EU",)]
    vocabulary = vocabulary_frame(spark, ["EU", "Strategie", "Low Code"])
    assert sorted(table(quality.unassigned_labels(issues, vocabulary))) == [
        ("Low Code",), ("Strategie",),
    ]
    assert sorted(table(quality.label_support(issues))) == [("Daten", 1), ("EU", 3)]
    assert table(quality.label_cooccurrence(issues)) == [("Daten", "EU", 1)]
    assert table(quality.labels_mostly_together(issues)) == []
    assert table(quality.labels_mostly_together(issues, 0.3)) == [("Daten", "EU", 1.0, 1 / 3)]


def test_share_must_exceed_the_threshold(spark):
    rows = [(["a", "b"],)] * 4 + [(["a"],), (["b"],)]
    df = spark.createDataFrame(rows, "labels_v1 array<string>")
    assert table(quality.labels_mostly_together(df, 0.8)) == []
    assert table(quality.labels_mostly_together(df, 0.79)) == [("a", "b", 0.8, 0.8)]


def test_schema_diff(spark):
    old = spark.createDataFrame([], "a int, b string")
    new = spark.createDataFrame([], "b string, c array<string>, a long")
    assert table(quality.schema_diff(old, new)) == [
        ("a", True, True, "int", "bigint"),
        ("b", True, True, "string", "string"),
        ("c", False, True, None, "array<string>"),
    ]
