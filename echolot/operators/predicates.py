"""Dashboard predicates. Each is one Column; together they make one filter."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolot.config import IssueFilter
from echolot.functions.labels import has_all


def label_filter(labels: Sequence[str], column: str = "labels_v1") -> Column:
    """Issues that carry all the labels."""
    return has_all(F.col(column), labels)


def _in_set(column: str, values: Sequence) -> Column:
    return F.col(column).isin(list(values)) if values else F.lit(True)


def page_filter(pages: Sequence[str]) -> Column:
    return _in_set("form_page", pages)


def author_filter(authors: Sequence[str]) -> Column:
    return _in_set("author_name", authors)


def org_filter(orgs: Sequence[str]) -> Column:
    return _in_set("org", orgs)


def round_filter(rounds: Sequence[int]) -> Column:
    return _in_set("feedback_round", rounds)


def sentiment_filter(low: float = -1.0, high: float = 1.0) -> Column:
    """Closed range; a missing score is outside of every range."""
    return F.col("sentiment").between(low, high)


def search_filter(term: str, literal: bool = False) -> Column:
    """Case-insensitive search, by regular expression unless ``literal``.

    Both sides are lower-cased, also the character classes of an expression.
    """
    if not term:
        return F.lit(True)
    text = F.lower("desc_clean")
    return text.contains(term.lower()) if literal else text.rlike(term.lower())


def issue_predicate(f: IssueFilter) -> Column:
    """Conjunction of all set filters, cheap ones first."""
    return reduce(
        and_,
        [
            sentiment_filter(*f.sentiment),
            round_filter(f.rounds),
            page_filter(f.pages),
            author_filter(f.authors),
            org_filter(f.orgs),
            label_filter(f.labels, f.label_column),
            search_filter(f.search, f.search_literal),
        ],
    )


def filtered_issues(df: DataFrame, f: IssueFilter) -> DataFrame:
    return df.filter(issue_predicate(f))
