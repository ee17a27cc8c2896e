"""Checks of label coverage, label overlap and table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echolot.functions.labels import label_set, pairs_with_self


def assigned_labels(df: DataFrame, label_column: str = "labels_v1") -> DataFrame:
    return df.select(F.explode(label_column).alias("label")).distinct().dropna()


def unassigned_labels(
    df: DataFrame, vocabulary: DataFrame, label_column: str = "labels_v1"
) -> DataFrame:
    """Labels of the vocabulary that no issue carries."""
    return vocabulary.join(assigned_labels(df, label_column), "label", "left_anti")


def label_sets(df: DataFrame, label_column: str = "labels_v1") -> DataFrame:
    """How many issues carry exactly this set of labels.

    Far fewer sets than issues exist, and counting them aggregates before the shuffle.
    The pair statistics start from here and so never expand the issues themselves.
    """
    sets = df.select(label_set(F.col(label_column)).alias("labels")).dropna()
    return sets.groupBy("labels").agg(F.count(F.lit(1)).alias("n"))


def label_support(df: DataFrame, label_column: str = "labels_v1") -> DataFrame:
    """Issues per label; a label repeated within an issue counts once."""
    labels = label_sets(df, label_column).select(F.explode("labels").alias("label"), "n")
    return labels.groupBy("label").agg(F.sum("n").alias("n_issues"))


def _pair_counts(df: DataFrame, label_column: str) -> DataFrame:
    pairs = label_sets(df, label_column).select(
        F.explode(pairs_with_self(F.col("labels"))).alias("pair"), "n"
    )
    return pairs.groupBy("pair.label_a", "pair.label_b").agg(F.sum("n").alias("n_issues"))


def label_cooccurrence(df: DataFrame, label_column: str = "labels_v1") -> DataFrame:
    """Issues per unordered pair of different labels."""
    return _pair_counts(df, label_column).filter(F.col("label_a") < F.col("label_b"))


def labels_mostly_together(
    df: DataFrame, threshold: float = 0.8, label_column: str = "labels_v1"
) -> DataFrame:
    """Pairs where each label occurs with the other in more than ``threshold`` of its issues.

    A pair of a label with itself holds the label's frequency. It reaches the pairs of
    that label over two windows on the small pair table, so nothing is joined.
    """
    own = F.when(F.col("label_a") == F.col("label_b"), F.col("n_issues"))
    pairs = (
        _pair_counts(df, label_column)
        .withColumn("n_a", F.max(own).over(W.partitionBy("label_a")))
        .withColumn("n_b", F.max(own).over(W.partitionBy("label_b")))
        .filter(F.col("label_a") < F.col("label_b"))
    )
    shares = pairs.select(
        "label_a",
        "label_b",
        (F.col("n_issues") / F.col("n_a")).alias("share_a_with_b"),
        (F.col("n_issues") / F.col("n_b")).alias("share_b_with_a"),
    )
    return shares.filter(
        (F.col("share_a_with_b") > threshold) & (F.col("share_b_with_a") > threshold)
    )


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """All columns of two tables: where they occur and with which type."""
    before = {f.name: f.dataType.simpleString() for f in old.schema.fields}
    after = {f.name: f.dataType.simpleString() for f in new.schema.fields}
    rows = [
        (name, name in before, name in after, before.get(name), after.get(name))
        for name in sorted(before.keys() | after.keys())
    ]
    return old.sparkSession.createDataFrame(
        rows, "column string, in_old boolean, in_new boolean, type_old string, type_new string"
    )
