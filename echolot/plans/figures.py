"""The dashboard's figures as mergeable partial aggregates of the versioned snapshot.

A version of a bucket never changes, so its figures are counted once, when it was written: one pass over
its rows, one shuffle of already aggregated rows, for all figures together. Reading adds up the partials of
the bucket versions that the newest commit names. Counts, days, labels, pages, authors, organisations and mean
sentiments are exact, also after edits, because an edited issue has its whole bucket counted again. The
number of authors is exact from the partials by author; a sketch of the authors gives it without them, with
a relative standard error of about 1.6 % (``SKETCH_BITS`` = 12).

Layout: ``figures/version=<n>/`` holds the partials of all buckets of a version; its ``_SUCCESS`` file tells that
they are whole, so a run that failed is repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.session import path_exists
from echolot.sources.snapshot import NEVER, Commit, current_commit, snapshot_schema

SKETCH_BITS = 12
ALL, DAY, LABEL, FORM, PAGE, AUTHOR, AUTHOR_ID, ORG = (
    "all", "day", "label", "form", "page", "author", "author_id", "org",
)
PARTIALS = "bucket int, dimension string, value string, n long, n_scores long, scores double, authors binary"


def _places(label_column: str) -> Column:
    """The (dimension, value) pairs that a row counts for; a missing or empty label list is one null."""

    def one(dimension: str, value: Column) -> Column:
        return F.struct(F.lit(dimension).alias("dimension"), value.cast("string").alias("value"))

    labels = F.when(F.size(label_column) > 0, F.col(label_column))
    labels = F.coalesce(labels, F.array(F.lit(None).cast("string")))
    return F.concat(
        F.array(
            one(ALL, F.lit(None)),
            one(DAY, F.to_date("created_at")),
            one(FORM, F.col("is_from_form")),
            one(PAGE, F.col("form_page")),
            one(AUTHOR, F.col("author_name")),
            one(AUTHOR_ID, F.col("author_id")),
            one(ORG, F.col("org")),
        ),
        F.transform(labels, lambda label: one(LABEL, label)),
    )


def partial_figures(rows: DataFrame, by: str, label_column: str = "labels_v1") -> DataFrame:
    """Partials of rows, one per ``by``, dimension and value. Only ``all`` keeps a sketch of the authors."""
    spread = rows.select(by, "sentiment", "author_id", F.inline(_places(label_column)))
    sketched = F.when(F.col("dimension") == ALL, F.col("author_id"))
    return spread.groupBy(by, "dimension", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("sentiment").alias("n_scores"),
        F.sum("sentiment").alias("scores"),
        F.hll_sketch_agg(sketched, SKETCH_BITS).alias("authors"),
    ).withColumn("authors", F.when(F.col("dimension") == ALL, F.col("authors")))


def _partials_path(base: str, version: int) -> str:
    return f"{base}/figures/version={version}"


def refresh_figures(
    spark: SparkSession, base: str, schema: T.StructType, label_column: str = "labels_v1"
) -> list[int]:
    """Count the versions that the newest commit names and that have no figures yet; returns them.

    Called after every merge this reads the buckets that the merge wrote and nothing else.
    """
    commit = current_commit(spark, base)
    if commit is None:
        return []
    missing = [
        version
        for version in sorted(set(commit.buckets) - {NEVER})
        if not path_exists(spark, f"{_partials_path(base, version)}/_SUCCESS")
    ]
    for version in missing:
        data = f"{base}/data/version={version}"
        named = [f"{data}/bucket={k}" for k, v in enumerate(commit.buckets) if v == version]
        reader = spark.read.schema(snapshot_schema(schema)).option("basePath", data)
        partials = partial_figures(reader.parquet(*named), "bucket", label_column)
        partials.write.mode("overwrite").parquet(_partials_path(base, version))
    return missing


def _named_partials(spark: SparkSession, base: str, commit: Commit | None) -> DataFrame:
    versions = sorted(set(commit.buckets) - {NEVER}) if commit else []
    if not versions:
        return spark.createDataFrame([], f"{PARTIALS}, version int")
    paths = [_partials_path(base, version) for version in versions]
    reader = spark.read.schema(f"{PARTIALS}, version int").option("basePath", f"{base}/figures")
    written = F.element_at(F.array(*map(F.lit, commit.buckets)), F.col("bucket") + 1)
    return reader.parquet(*paths).where(F.col("version") == written)


def read_figures(spark: SparkSession, base: str) -> DataFrame:
    """(bucket, dimension, value, n, n_scores, scores, authors): the partials of the newest commit.

    They are those of one commit, also while another is merged. A version without figures fails the read.
    """
    return _named_partials(spark, base, current_commit(spark, base)).drop("version")


def overview(figures: DataFrame, approximate: bool = False) -> DataFrame:
    """Row count, mean sentiment and number of authors; a missing author is one value.

    ``approximate`` merges the sketches and reads one row per bucket; else the partials by author are counted.
    """
    whole = F.col("dimension") == ALL
    author = F.col("dimension") == AUTHOR_ID
    if approximate:
        author = author & F.col("value").isNull()
    merged = [F.sum(name).alias(name) for name in ("n", "n_scores", "scores")]
    if approximate:
        merged.append(F.hll_sketch_estimate(F.hll_union_agg("authors")).alias("sketched"))
    values = figures.where(whole | author).groupBy("dimension", "value").agg(*merged)

    def total(name: str) -> Column:
        return F.sum(F.when(whole, F.col(name)))

    number = F.count(F.when(author, 1))
    if approximate:
        number = number + F.coalesce(total("sketched"), F.lit(0))
    return values.agg(
        F.coalesce(total("n"), F.lit(0)).alias("n_issues"),
        F.try_divide(total("scores"), total("n_scores")).alias("mean_sentiment"),
        number.alias("n_authors"),
    )


def _mean() -> Column:
    return F.try_divide(F.sum("scores"), F.sum("n_scores"))


def _of(figures: DataFrame, dimension: str, name: str, kind: str) -> DataFrame:
    rows = figures.where(F.col("dimension") == dimension)
    return rows.withColumn(name, F.col("value").cast(kind)).groupBy(name)


def counts(figures: DataFrame, dimension: str, name: str | None = None, kind: str = "string") -> DataFrame:
    """Issues per value, most frequent first."""
    name = name or dimension
    rows = _of(figures, dimension, name, kind).agg(F.sum("n").alias("n_issues"))
    return rows.orderBy(F.desc("n_issues"), name)


def mean_sentiments(
    figures: DataFrame, dimension: str, name: str | None = None, nulls_first: bool = True
) -> DataFrame:
    """Mean sentiment per value, highest first."""
    name = name or dimension
    rows = _of(figures, dimension, name, "string").agg(_mean().alias("mean_sentiment"))
    order = F.desc_nulls_first if nulls_first else F.desc_nulls_last
    return rows.orderBy(order("mean_sentiment"), name)


def per_day(figures: DataFrame) -> DataFrame:
    """Issues per calendar day, ascending; days without issues are absent."""
    return _of(figures, DAY, "day", "date").agg(F.sum("n").alias("n_issues")).orderBy("day")


def dashboard_figures(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The frames of ``dashboard.all_figures`` over the whole snapshot, from the partials alone."""
    figures = read_figures(spark, base)
    return {
        "overview": overview(figures),
        "per_day": per_day(figures),
        "labels": counts(figures, LABEL),
        "form": counts(figures, FORM, "is_from_form", "boolean"),
        "sentiment_by_label": mean_sentiments(figures, LABEL),
        "sentiment_by_page": mean_sentiments(figures, PAGE, "form_page", nulls_first=False),
        "authors": counts(figures, AUTHOR, "author_name"),
        "orgs": counts(figures, ORG),
    }
