"""Versioned snapshot of the newest version of every issue, in buckets by a hash of ``iid``.

A merge reads only the files that the processed table got since the last one, rewrites only the buckets
of their issues and then commits. A commit is a small file, numbered and never overwritten: it
names, for every bucket, the version that wrote it. Readers take the newest commit, so they see the old
version as a whole until the new one is whole; of two merges at once the later commit fails. If files
of the table went or changed (a partition was replaced), the snapshot is built anew from the table.

Layout: ``data/version=<n>/bucket=<k>/`` rows, ``files/`` the table's files by version, ``commits/<n>.json``,
``figures/version=<n>/`` partial aggregates (``plans/figures.py``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.session import create_file, path_exists, remove_path
from echolot.sources.landing import FILE_SCHEMA, LandedFile, list_files, literal_path
from echolot.sources.tables import BATCH_COLUMN, COMPRESSION, PARTITION_COLUMN, latest_per_issue

BUCKETS = 64
BUCKET_BYTES = 64 * 1024 * 1024  # of the table's files; one task sorts and writes a bucket
MANY_VERSIONS = 1000
NEVER = -1  # the version of a bucket that no one wrote


@dataclass(frozen=True)
class Commit:
    version: int
    buckets: tuple[int, ...]

    def paths(self, base: str) -> list[str]:
        return [f"{base}/data/version={v}/bucket={k}" for k, v in enumerate(self.buckets) if v != NEVER]


def snapshot_schema(schema: T.StructType) -> T.StructType:
    """The table's columns and its partition columns; ``ingest_batch`` is null where a batch run wrote."""
    return T.StructType([*schema.fields]).add(PARTITION_COLUMN, "date").add(BATCH_COLUMN, "long")


def current_commit(spark: SparkSession, base: str) -> Commit | None:
    folder = f"{base}/commits"
    if not path_exists(spark, folder):
        return None
    schema = "version int, buckets array<int>"
    row = spark.read.schema(schema).json(folder).orderBy(F.desc("version")).first()
    return Commit(row.version, tuple(row.buckets)) if row else None


def _table_rows(spark: SparkSession, files: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some files of the table, partition values taken from the paths."""
    if not files:
        return spark.createDataFrame([], snapshot_schema(schema))
    path = F.col("_metadata.file_path")
    day = F.regexp_extract(path, f"/{PARTITION_COLUMN}=([^/]*)/", 1)
    batch = F.regexp_extract(path, f"/{BATCH_COLUMN}=([^/]*)/", 1)
    # Each file is read by itself, so folders of different depths go together.
    reader = spark.read.option("recursiveFileLookup", "true").schema(schema)
    rows = reader.parquet(*[literal_path(file) for file in files])
    return rows.withColumns(
        {
            PARTITION_COLUMN: F.when(day != "", day).cast("date"),
            BATCH_COLUMN: F.when(batch != "", batch).cast("long"),
        }
    )


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("iid"), F.lit(buckets)).cast("int")


def _newest(rows: DataFrame, number: int, fresh: DataFrame) -> DataFrame:
    """The newest version of each issue, sorted by its ``bucket``; wide rows move once, to their bucket.

    Only fresh rows can repeat an issue more than once. Issues with very many versions are told by a
    count of the numbers alone, and cut to one version first, so they do not go through one task.
    """
    versions = fresh.groupBy("iid").agg(F.count(F.lit(1)).alias("n"))
    many = F.broadcast(versions.where(F.col("n") > MANY_VERSIONS).select(F.col("iid").alias("_many")))
    if not many.isEmpty():
        same = F.col("iid").eqNullSafe(F.col("_many"))
        rows = rows.join(many, same, "left_anti").unionByName(latest_per_issue(rows.join(many, same, "left_semi")))
    dealt = rows.withColumn("bucket", _bucket(number)).repartition("bucket")
    return latest_per_issue(dealt, dealt_by="bucket")


def merge_snapshot(
    spark: SparkSession, table: str, base: str, schema: T.StructType, buckets: int = BUCKETS
) -> Commit:
    """Bring the snapshot up to the table.

    ``buckets`` counts only for a new snapshot and is the least number: a snapshot that is built from all files
    gets one bucket for each ``BUCKET_BYTES`` of them, so that a bucket's size does not grow with the table.
    """
    before = current_commit(spark, base)
    now = {f.path: f for f in (LandedFile(*r) for r in list_files(spark, table).collect()) if f.path.endswith(".parquet")}
    known = _known_files(spark, base, before)
    gone = any(now.get(path) != file for path, file in known.items())
    if gone or before is None:
        number = max(len(before.buckets) if before else buckets, -(-sum(f.bytes for f in now.values()) // BUCKET_BYTES))
        last, keep, fresh = before, Commit(NEVER, (NEVER,) * number), sorted(now)
    else:
        last, keep, fresh = before, before, sorted(set(now) - set(known))
        if not fresh:
            return before
    number = len(keep.buckets)
    version = last.version + 1 if last else 0
    rows = added = _table_rows(spark, fresh, schema)
    touched = sorted(row.bucket for row in rows.select(_bucket(number).alias("bucket")).distinct().collect())
    old = [f"{base}/data/version={keep.buckets[k]}/bucket={k}" for k in touched if keep.buckets[k] != NEVER]
    if old:
        earlier = spark.read.schema(snapshot_schema(schema)).parquet(*old)
        rows = rows.unionByName(earlier)
    newest = _newest(rows, number, added)
    data = f"{base}/data/version={version}"
    remove_path(spark, data)  # what a merge left that failed before its commit
    # One task writes a bucket as one file.
    newest.write.partitionBy("bucket").parquet(data, compression=COMPRESSION)
    _record_files(spark, base, version, [now[path] for path in fresh], whole=keep.version == NEVER)
    after = tuple(version if k in set(touched) else v for k, v in enumerate(keep.buckets))
    commit = Commit(version, after)
    text = json.dumps({"version": version, "buckets": list(after)})
    create_file(spark, f"{base}/commits/{version:08d}.json", text)
    return commit


def _known_files(spark: SparkSession, base: str, commit: Commit | None) -> dict[str, LandedFile]:
    """The table's files that the committed versions hold, since the last one that was built anew."""
    if commit is None:
        return {}
    rows = spark.read.schema(f"{FILE_SCHEMA}, whole boolean, version int").parquet(f"{base}/files")
    rows = rows.where(F.col("version") <= commit.version).collect()
    start = max((r.version for r in rows if r.whole), default=0)
    return {r.path: LandedFile(r.path, r.modified, r.bytes) for r in rows if r.version >= start and r.path}


def _record_files(spark: SparkSession, base: str, version: int, files: list[LandedFile], whole: bool) -> None:
    rows = [(f.path, f.modified, f.bytes, whole) for f in files] or [(None, None, None, whole)]
    frame = spark.createDataFrame(rows, f"{FILE_SCHEMA}, whole boolean").withColumn("version", F.lit(version))
    writer = frame.coalesce(1).write.partitionBy("version").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{base}/files")


def read_current(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """The rows of the newest commit. A frame keeps its version while later ones are merged."""
    commit = current_commit(spark, base)
    whole = snapshot_schema(schema)
    if commit is None or not commit.paths(base):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(*commit.paths(base))


def expire(spark: SparkSession, base: str, keep: int = 2) -> int:
    """Remove bucket folders, and figures of versions, that none of the newest ``keep`` commits names.

    Returns the number of bucket folders.
    """
    schema = "version int, buckets array<int>"
    commits = spark.read.schema(schema).json(f"{base}/commits").orderBy(F.desc("version")).collect()
    named = {(v, k) for c in commits[:keep] for k, v in enumerate(c.buckets)}
    written = {(v, k) for c in commits for k, v in enumerate(c.buckets) if v != NEVER}
    old = [f"{base}/data/version={v}/bucket={k}" for v, k in sorted(written - named)]
    old = [path for path in old if path_exists(spark, path)]
    for path in old:
        remove_path(spark, path)
    for version in {v for v, _ in written} - {v for v, _ in named}:
        remove_path(spark, f"{base}/figures/version={version}")
    return len(old)
