"""Facets, samples and cards: what the dashboard offers for choosing and reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.functions.text import two_decimals

# German captions of the result columns.
CAPTIONS = {
    "day": "Datum",
    "n_issues": "Anzahl Issues",
    "label": "Label",
    "is_from_form": "Formular",
    "mean_sentiment": "Durchschnittlicher Sentiment",
    "form_page": "Seite",
    "author_name": "Autor*in",
    "org": "Organisation",
}


def facet(df: DataFrame, column: str, explode: bool = False, name: str | None = None) -> DataFrame:
    """Distinct values of a column without null, sorted."""
    value = F.explode(column) if explode else F.col(column)
    values = df.select(value.alias(name or column)).distinct().dropna()
    return values.orderBy(name or column)


def with_captions(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(CAPTIONS)


def sample_issues(df: DataFrame, n: int = 1, seed: int | None = None) -> DataFrame:
    """``n`` random rows without replacement.

    Each task keeps its own ``n`` smallest keys and only those meet. With a seed the key
    is a hash of the issue number, so the same rows come back.
    """
    if seed is None:
        key = [F.rand()]
    else:
        key = [F.md5(F.concat(F.lit(f"{seed}:"), F.col("iid").cast("string"))), F.col("iid")]
    return df.orderBy(*key).limit(n)


def issue_cards(df: DataFrame, label_column: str = "labels_v1") -> DataFrame:
    """Texts of the sample card."""
    labels = F.col(label_column)
    joined = F.when(F.size(labels) > 0, F.array_join(labels, ", ")).otherwise("None")
    return df.select(
        "iid",
        "title",
        "desc_clean",
        "form_page",
        joined.alias("labels"),
        two_decimals(F.col("sentiment")).alias("sentiment"),
        "author_name",
    )
