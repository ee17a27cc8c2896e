"""Parquet tables: stages, the processed table by processing date, and its versions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.operators.cleaning import content_key
from echolot.schemas import ISSUE_SCHEMA
from echolot.session import path_exists

PARTITION_COLUMN = "processing_date"
BATCH_COLUMN = "ingest_batch"

# Texts lie twice in the processed table; this takes about a third less than the default codec.
COMPRESSION = "zstd"


def read_existing(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame | None:
    """A Parquet table with a known schema, or None where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a stage table and go on from the files, which cuts the lineage."""
    df.write.mode("overwrite").parquet(path, compression=COMPRESSION)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_partition(
    df: DataFrame,
    base: str,
    processing_date: date,
    mode: str = "overwrite",
    batch: int | None = None,
) -> None:
    """Write one partition of the processed table.

    ``overwrite`` replaces that partition only, so a repeated run leaves one result.
    ``append`` keeps what an earlier run of the day wrote. ``batch`` adds a second
    partition level, for several batches a day that must not replace each other.
    """
    columns = [PARTITION_COLUMN]
    df = df.withColumn(PARTITION_COLUMN, F.lit(processing_date))
    if batch is not None:
        columns.append(BATCH_COLUMN)
        df = df.withColumn(BATCH_COLUMN, F.lit(batch).cast("long"))
    writer = df.write.partitionBy(*columns).mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").parquet(base, compression=COMPRESSION)


def load_issues(
    spark: SparkSession,
    base: str,
    schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """All partitions of the processed table, columns in sorted order.

    Columns that a partition lacks are null there. The columns are those of all
    partitions; with a given ``schema`` no file footer is read for that. A file that
    cannot be read fails the read; with ``skip_corrupt`` its rows are left out. A missing
    table gives an empty frame.
    """
    partition = T.StructField(PARTITION_COLUMN, T.DateType())
    reader = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
    if not path_exists(spark, base):
        df = spark.createDataFrame([], T.StructType([*(schema or ISSUE_SCHEMA).fields, partition]))
    elif schema is not None:
        df = reader.schema(T.StructType([*schema.fields, partition])).parquet(base)
    else:
        df = reader.option("mergeSchema", "true").parquet(base)
    return df.select(*sorted(df.columns))


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames over the set of all their columns, in sorted order."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return union.select(*sorted(union.columns))


def latest_per_issue(
    df: DataFrame,
    key: str = "iid",
    order: Sequence[str] | None = None,
    dealt_by: str | None = None,
) -> DataFrame:
    """The newest version of each issue: by processing date, time of update and micro-batch, as far as
    there are such columns. Versions equal in these are told apart by a hash of all columns, so the
    choice is the same in every run.

    Rank 1 trims each key within the task before the shuffle, so an issue with very many
    versions sends one row per task. ``dealt_by`` names a column that follows from the key, by which the
    rows were already repartitioned: they move no more, come sorted by it, and it has no part in the choice.
    """
    columns = sorted(column for column in df.columns if column != dealt_by)
    if order is None:
        order = [c for c in (PARTITION_COLUMN, "updated_at", BATCH_COLUMN) if c in df.columns]
    last = F.desc(F.xxhash64(*columns))
    newest = W.partitionBy(*([dealt_by] if dealt_by else []), key).orderBy(*(F.desc_nulls_last(column) for column in order), last)
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def known_keys(
    spark: SparkSession, path: str, column: str, run: date | int, own: bool = False
) -> DataFrame | None:
    """Content keys of other runs with the issues that own them; ``own`` adds this run's keys."""
    kind = "date" if isinstance(run, date) else "long"
    keys = read_existing(spark, path, f"content_key string, iid long, {column} {kind}")
    if keys is None:
        return None
    other = F.col(column) < F.lit(run) if kind == "date" else F.col(column) != F.lit(run)
    return keys.filter(other | (F.col(column) == F.lit(run))) if own else keys.filter(other)


def not_yet_written(df: DataFrame, partition: str | Sequence[str]) -> DataFrame:
    """The rows whose version of an issue a partition lacks, so that a repeated append adds nothing.

    The partition is a path or some folders with its rows.
    """
    spark, schema = df.sparkSession, "iid long, updated_at timestamp_ntz"
    if isinstance(partition, str):
        written = read_existing(spark, partition, schema)
    else:
        written = spark.read.schema(schema).parquet(*partition) if partition else None
    if written is None:
        return df
    written = written.select(F.col("iid").alias("_iid"), F.col("updated_at").alias("_updated"))
    same = F.col("iid").eqNullSafe(F.col("_iid")) & F.col("updated_at").eqNullSafe(F.col("_updated"))
    return df.join(written, same, "left_anti")


def write_known_keys(
    spark: SparkSession, partition: str, path: str, column: str, run: date | int
) -> None:
    """Remember the content keys of a partition just written, in a partition of their own."""
    written = read_existing(spark, partition, "iid long, title string, description string")
    if written is None:
        return
    keys = written.select(content_key().alias("content_key"), "iid", F.lit(run).alias(column))
    writer = keys.write.partitionBy(column).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
