"""Cleaning: from raw tracker records to prepared and post-processed issues."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from echolot.config import IngestConfig
from echolot.functions.iso_time import parse_lenient, parse_strict
from echolot.functions.labels import default_label
from echolot.functions.text import drop_prefix, drop_suffix, strip

DEFAULT = IngestConfig()


def new_issues(
    df: DataFrame,
    watermark: datetime | None,
    column: str = "created_at",
    strict: bool = True,
) -> DataFrame:
    """Rows later than the watermark; no watermark keeps all rows.

    ``strict`` fails the job on a row without a timestamp. Without it such rows drop and
    the comparison reaches a Parquet scan as a pushed filter.
    """
    return df if watermark is None else df.filter(later_than(watermark, column, strict))


def later_than(watermark: datetime | None, column: str, strict: bool = True) -> Column:
    """Whether a row is later than the watermark, as in ``new_issues``."""
    if watermark is None:
        return F.lit(True)
    # As text, because a datetime literal would pass through the time zone of the session.
    later = F.col(column) > F.lit(watermark.isoformat(" ")).cast("timestamp_ntz")
    if strict:
        missing = F.raise_error(F.lit(f"issue without {column}")).cast("boolean")
        later = F.when(F.col(column).isNull(), missing).otherwise(later)
    return later


def flatten_author(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "author_id": F.col("author.id"),
            "author_name": F.col("author.name"),
            "author_state": F.col("author.state"),
        }
    )


def parse_timestamps(df: DataFrame) -> DataFrame:
    """ISO text to timestamps: strict for creation and update, lenient for closing."""
    df = df.withColumns(
        {name: parse_strict(F.col(name)) for name in ("created_at", "updated_at")}
    )
    if "closed_at" in df.columns:
        df = df.withColumn("closed_at", parse_lenient(F.col("closed_at")))
    return df


def exclude_ids(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    return df.filter(~F.col("iid").isin(*cfg.excluded_iids))


def dedupe_issues(df: DataFrame, by: str | None = None) -> DataFrame:
    """One row per title and description, the earliest issue in its newest version; null equals null.

    The hash comes first in the key, so sorting compares numbers and looks at the long
    texts only on equal hashes. Rank 1 plans as a group limit before the shuffle: each
    task passes on one row per key, however many copies the key has. ``by`` names a
    column that already holds the key.
    """
    key = [by] if by else ["_hash", "title", "description"]
    newest = [F.desc_nulls_last("updated_at")] if "updated_at" in df.columns else []
    order = W.partitionBy(*key).orderBy("created_at", "iid", *newest)
    return (
        df.withColumn("_hash", F.xxhash64("title", "description"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") == 1)
        .drop("_hash", "_rank")
    )


def content_key() -> Column:
    """SHA-256 of title and description; tells null from text."""
    return F.sha2(
        F.to_json(F.struct("title", "description"), {"ignoreNullFields": "false"}), 256
    )


def dedupe_against(df: DataFrame, known: DataFrame) -> DataFrame:
    """One row per title and description, without those that another issue owns in
    ``known(content_key, iid)``. A newer version of the owner stays.

    Both steps use the same key, so the rows are shuffled once.
    """
    unique = dedupe_issues(df.withColumn("content_key", content_key()), "content_key")
    owned = known.select(F.col("content_key").alias("_key"), F.col("iid").alias("_owner"))
    other = F.col("_owner").isNull() | (F.col("_owner") != F.col("iid"))
    new = unique.join(owned, (F.col("content_key") == F.col("_key")) & other, "left_anti")
    return new.drop("content_key")


def clean_issues(
    df: DataFrame, cfg: IngestConfig = DEFAULT, known: DataFrame | None = None
) -> DataFrame:
    """Flatten, type, exclude, de-duplicate and project raw records.

    De-duplication covers the given rows, and the earlier ones where their content keys
    are given as ``known``.
    """
    typed = exclude_ids(df.transform(flatten_author).transform(parse_timestamps), cfg)
    unique = dedupe_issues(typed) if known is None else dedupe_against(typed, known)
    return unique.select(*cfg.clean_columns)


def clean_description(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    text = F.replace(F.col("description"), F.lit(cfg.boilerplate), F.lit(""))
    return df.withColumn("desc_clean", text)


def form_source(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    """Whether the issue came through the web form, and from which page."""
    title = F.col("title")
    from_form = title.startswith(cfg.form_prefix)
    page = strip(drop_prefix(title, cfg.form_prefix))
    return df.withColumns(
        {
            "is_from_form": from_form,
            "form_page": F.when(from_form, page).otherwise(F.lit(cfg.non_form_page)),
        }
    )


def exclude_descriptions(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    """Drop boilerplate descriptions; a missing description drops too."""
    return df.filter(~F.col("desc_clean").isin(*cfg.excluded_descriptions))


def prepare_issues(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    return exclude_descriptions(form_source(clean_description(df, cfg), cfg), cfg)


def default_labels(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    name = cfg.label_column
    return df.withColumn(name, default_label(F.col(name), cfg.unclear))


def exclude_pages(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    return df.filter(~F.col("form_page").isin(*cfg.excluded_pages))


def normalize_pages(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    """The root page is the home page; other pages lose one trailing slash."""
    page = F.col("form_page")
    named = F.when(page == "/", F.lit(cfg.home_page)).otherwise(drop_suffix(page, "/"))
    return df.withColumn("form_page", named)


def postprocess_issues(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    """Default labels, then page exclusion, then page names: the order matters."""
    return normalize_pages(exclude_pages(default_labels(df, cfg), cfg), cfg)


def feedback_round(df: DataFrame, cfg: IngestConfig = DEFAULT) -> DataFrame:
    created = F.col("created_at")
    number = F.when(F.year(created) == cfg.second_round_year, 2).otherwise(1)
    return df.withColumn("feedback_round", F.when(created.isNotNull(), number).cast("tinyint"))
