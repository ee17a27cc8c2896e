"""Column helpers for label lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from echolot.functions.text import PYTHON_WHITE_SPACE, strip


def validate_labels(answer: Column, allowed: Sequence[str]) -> Column:
    """Comma-separated answer to the list of its allowed labels.

    Case counts, order and repetitions stay, and no maximum applies. A missing answer
    gives an empty list.
    """
    parts = F.transform(F.split(answer, ","), lambda part: strip(part, PYTHON_WHITE_SPACE))
    valid = F.filter(parts, lambda label: label.isin(list(allowed)))
    return F.coalesce(valid, F.array().cast("array<string>"))


def default_label(labels: Column, unclear: str) -> Column:
    """An empty list becomes ``[unclear]``; null stays null."""
    return F.when(F.size(labels) == 0, F.array(F.lit(unclear))).otherwise(labels)


def has_all(labels: Column, wanted: Sequence[str]) -> Column:
    """True where the list holds every wanted label."""
    condition = F.lit(True)
    for label in wanted:
        condition = condition & F.array_contains(labels, label)
    return condition


def label_set(labels: Column) -> Column:
    """The labels of one issue, sorted and each once, without nulls."""
    return F.array_sort(F.array_compact(F.array_distinct(labels)))


def pairs_with_self(labels: Column) -> Column:
    """All pairs ``(a, b)`` with ``a <= b`` of a sorted list without repetitions.

    The pair of a label with itself carries the label's own frequency.
    """

    def from_position(a: Column, i: Column) -> Column:
        partners = F.slice(labels, i + 1, F.size(labels))
        return F.transform(partners, lambda b: F.struct(a.alias("label_a"), b.alias("label_b")))

    return F.flatten(F.transform(labels, from_position))
