"""The dashboard as data: every frame the exploration page shows, for one filter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from echolot.config import IssueFilter
from echolot.operators.facets import facet, issue_cards, sample_issues
from echolot.operators.metrics import (
    count_by,
    issues_per_day,
    mean_sentiment_by,
    overview_metrics,
)
from echolot.operators.predicates import filtered_issues
from echolot.schemas import issue_schema
from echolot.sources.snapshot import BUCKETS, merge_snapshot, read_current
from echolot.sources.tables import BATCH_COLUMN, latest_per_issue, load_issues


def current_issues(spark: SparkSession, table: str, label_version: int = 1) -> DataFrame:
    """The newest version of every issue. Filters come after it, never before."""
    return latest_per_issue(load_issues(spark, table, issue_schema(label_version)))


def publish_snapshot(
    spark: SparkSession, table: str, path: str, label_version: int = 1, buckets: int = BUCKETS
) -> DataFrame:
    """Bring the snapshot of the current issues up to the table; the dashboard reads it without a shuffle.

    Filters reach the scan of a snapshot, which they cannot through the choice of the
    newest version. Only the buckets of changed issues are written, and readers see the old
    version until the new one is whole.
    """
    merge_snapshot(spark, table, path, issue_schema(label_version), buckets)
    return read_snapshot(spark, path, label_version)


def read_snapshot(spark: SparkSession, path: str, label_version: int = 1) -> DataFrame:
    return read_current(spark, path, issue_schema(label_version)).drop(BATCH_COLUMN)


def facets(df: DataFrame, label_column: str = "labels_v1") -> dict[str, DataFrame]:
    return {
        "labels": facet(df, label_column, explode=True, name="label"),
        "pages": facet(df, "form_page"),
        "authors": facet(df, "author_name"),
        "orgs": facet(df, "org"),
        "rounds": facet(df, "feedback_round"),
    }


def dashboard(df: DataFrame, f: IssueFilter, seed: int | None = None) -> dict[str, DataFrame]:
    """Lazy frames over one filtered table; each reads only the columns it needs."""
    issues, label = filtered_issues(df, f), f.label_column
    sample = issue_cards(sample_issues(issues, 1, seed), label)
    return {"sample": sample, **all_figures(issues, label)}


def all_figures(issues: DataFrame, label: str = "labels_v1") -> dict[str, DataFrame]:
    """The figures of all rows, those without a score among them."""
    return {
        "overview": overview_metrics(issues),
        "per_day": issues_per_day(issues),
        "labels": count_by(issues, label, explode=True, name="label"),
        "form": count_by(issues, "is_from_form"),
        "sentiment_by_label": mean_sentiment_by(issues, label, explode=True, name="label"),
        "sentiment_by_page": mean_sentiment_by(issues, "form_page", nulls_first=False),
        "authors": count_by(issues, "author_name"),
        "orgs": count_by(issues, "org"),
    }
