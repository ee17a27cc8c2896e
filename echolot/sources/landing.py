"""The landing folder between runs: which files are new, told without opening any of them.

A manifest is a Parquet table of the files that runs have read, one record for each path with its
time of modification and size. A file is unread if the manifest lacks that record, so late files with old
times are found, and a file that was rewritten is read again. A run lists the folder once and
records that list after its state, so a run that fails in between only reads its files again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.session import path_exists
from echolot.sources.tables import read_existing

FILE_SCHEMA = "path string, modified timestamp, bytes long"


@dataclass(frozen=True)
class LandedFile:
    path: str
    modified: datetime
    bytes: int


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, modified, bytes) of the files below a folder; their content is not read."""
    if not path_exists(spark, folder):
        return spark.createDataFrame([], FILE_SCHEMA)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def unread_files(spark: SparkSession, folder: str, manifest: str | DataFrame | None) -> list[LandedFile]:
    """The files of a folder that the manifest, a path or its rows, lacks, in the order of their paths.

    The list lies on the driver, as Spark's own list of the files of a read does.
    """
    files = list_files(spark, folder)
    known = read_existing(spark, manifest, FILE_SCHEMA) if isinstance(manifest, str) else manifest
    if known is not None:
        files = files.join(known, ["path", "modified", "bytes"], "left_anti")
    return [LandedFile(*row) for row in files.orderBy("path").collect()]


def record_files(spark: SparkSession, files: list[LandedFile], manifest: str) -> None:
    """Add files to the manifest; records are only added."""
    if files:
        rows = [(f.path, f.modified, f.bytes) for f in files]
        spark.createDataFrame(rows, FILE_SCHEMA).coalesce(1).write.mode("append").parquet(manifest)


def literal_path(path: str) -> str:
    """A path for a reader, which would take some of its characters for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)
