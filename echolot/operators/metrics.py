"""Metrics and grouped counts of the dashboard.

All group-bys aggregate partially before the shuffle, so a value that a third of the
rows share costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def overview_metrics(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, mean sentiment and number of authors; a missing author is one value."""
    if approximate:
        authors = F.approx_count_distinct("author_id")
    else:
        authors = F.count_distinct("author_id")
    missing = F.coalesce(F.max(F.col("author_id").isNull().cast("int")), F.lit(0))
    return df.agg(
        F.count(F.lit(1)).alias("n_issues"),
        F.avg("sentiment").alias("mean_sentiment"),
        (authors + missing).alias("n_authors"),
    )


def _grouped(df: DataFrame, column: str, explode: bool, name: str) -> DataFrame:
    """Group by a column, or by its list elements with null for missing and empty lists."""
    value = F.explode_outer(column) if explode else F.col(column)
    return df.select(value.alias(name), "sentiment")


def count_by(
    df: DataFrame, column: str, explode: bool = False, name: str | None = None
) -> DataFrame:
    """Issues per value, most frequent first."""
    name = name or column
    value = F.explode_outer(column) if explode else F.col(column)
    counts = df.select(value.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n_issues"))
    return counts.orderBy(F.desc("n_issues"), name)


def mean_sentiment_by(
    df: DataFrame,
    column: str,
    explode: bool = False,
    name: str | None = None,
    nulls_first: bool = True,
) -> DataFrame:
    """Mean sentiment per value, highest first."""
    name = name or column
    mean = F.avg("sentiment").alias("mean_sentiment")
    order: Column = F.desc_nulls_first("mean_sentiment")
    if not nulls_first:
        order = F.desc_nulls_last("mean_sentiment")
    return _grouped(df, column, explode, name).groupBy(name).agg(mean).orderBy(order, name)


def issues_per_day(df: DataFrame) -> DataFrame:
    """Issues per calendar day, ascending; days without issues are absent."""
    day = F.to_date("created_at").alias("day")
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n_issues")).orderBy("day")
