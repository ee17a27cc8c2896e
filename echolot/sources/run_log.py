"""Two-step publication: what a run wrote counts from the moment its commit exists, and not before.

A run writes its rows, the list of files it read and its content keys into folders of its own, told by a
random run id. Then it commits: one small file, numbered one above the commit it started from and never
overwritten, holds the run id, the day and the new state. Rows, state, files and keys of a run so become
visible together, or not at all. A run that fails leaves folders that no commit names; readers pass them by,
and the next run starts from the last commit. Of two runs that started from the same commit the second to
end fails with ``RunConflict``, and nothing of it can be seen.

Layout: ``<log>/commits/<number>.json``, ``<log>/files/run_id=<id>/``, ``<log>/keys/run_id=<id>/`` and
``<table>/processing_date=<day>/run_id=<id>/``. The commits are small and as many as runs; the driver lists them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.operators.cleaning import content_key
from echolot.schemas import ISSUE_SCHEMA
from echolot.session import create_file, path_exists, remove_path
from echolot.sources.landing import FILE_SCHEMA, LandedFile, record_files
from echolot.sources.run_state import FIRST_RUN, RunState
from echolot.sources.tables import COMPRESSION, PARTITION_COLUMN

RUN_COLUMN = "run_id"
COMMIT_SCHEMA = (
    "number int, run_id string, day date, replaces boolean, rows boolean, has_keys boolean, "
    "watermark string, fetched long, processed long"
)


class RunConflict(RuntimeError):
    """Another run committed since this one started."""


@dataclass(frozen=True)
class Run:
    """One run: its number is taken by the commit, its id names its folders."""

    number: int
    run_id: str
    day: date
    replaces: bool = False
    rows: bool = True
    has_keys: bool = False
    state: RunState = FIRST_RUN

    def folder(self, table: str) -> str:
        return f"{table}/{PARTITION_COLUMN}={self.day.isoformat()}/{RUN_COLUMN}={self.run_id}"


def committed_runs(spark: SparkSession, log: str) -> list[Run]:
    """All commits, oldest first."""
    folder = f"{log}/commits"
    if not path_exists(spark, folder):
        return []
    rows = spark.read.schema(COMMIT_SCHEMA).option("mode", "FAILFAST").json(folder).orderBy("number").collect()
    return [
        Run(
            r.number, r.run_id, r.day, r.replaces, r.rows, r.has_keys,
            RunState(datetime.fromisoformat(r.watermark) if r.watermark else None, r.fetched, r.processed),
        )
        for r in rows
    ]


def start_run(runs: Sequence[Run], day: date, replaces: bool = False) -> Run:
    """A run that follows the last commit, with its state; nothing is written yet.

    ``replaces`` hides the rows of the day's earlier runs from the moment of the commit.
    """
    number, state = (runs[-1].number, runs[-1].state) if runs else (0, FIRST_RUN)
    return Run(number + 1, f"r{uuid.uuid4().hex}", day, replaces, state=state)


def visible_runs(runs: Sequence[Run], day: date | None = None) -> list[Run]:
    """The runs whose rows count, of one day or all: a replacing run hides its day's earlier ones."""
    last = {run.day: run.number for run in runs if run.replaces}
    return [
        run
        for run in runs
        if run.number >= last.get(run.day, 0) and run.rows and (day is None or run.day == day)
    ]


def write_run(issues: DataFrame, table: str, run: Run) -> None:
    """Step one: the rows of a run into its own folder, which no reader opens yet."""
    issues.write.mode("error").parquet(run.folder(table), compression=COMPRESSION)


def write_run_keys(spark: SparkSession, table: str, log: str, run: Run) -> None:
    """Content keys of the rows just written, for the runs that follow the commit."""
    rows = spark.read.schema("iid long, title string, description string").parquet(run.folder(table))
    keys = rows.select(content_key().alias("content_key"), "iid")
    keys.write.mode("error").parquet(f"{log}/keys/{RUN_COLUMN}={run.run_id}")


def commit_run(spark: SparkSession, log: str, run: Run, files: list[LandedFile] = ()) -> None:
    """Step two: the run counts from here on. ``files`` are the landed files that it read."""
    record_files(spark, list(files), f"{log}/files/{RUN_COLUMN}={run.run_id}")
    watermark = run.state.last_successful_run
    commit = {
        "number": run.number,
        "run_id": run.run_id,
        "day": run.day.isoformat(),
        "replaces": run.replaces,
        "rows": run.rows,
        "has_keys": run.has_keys,
        "watermark": watermark.isoformat() if watermark else None,
        "fetched": run.state.last_fetched_issues,
        "processed": run.state.total_issues_processed,
    }
    path = f"{log}/commits/{run.number:010d}.json"
    try:
        create_file(spark, path, json.dumps(commit))
    except Py4JJavaError as failed:
        if not path_exists(spark, path):
            raise
        raise RunConflict(f"run {run.number} was committed by another run") from failed


def committed_files(spark: SparkSession, log: str, runs: Sequence[Run]) -> DataFrame:
    """The landed files that committed runs have read."""
    paths = [f"{log}/files/{RUN_COLUMN}={run.run_id}" for run in runs]
    paths = [path for path in paths if path_exists(spark, path)]
    return spark.read.schema(FILE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], FILE_SCHEMA)


def committed_keys(spark: SparkSession, log: str, runs: Sequence[Run]) -> DataFrame | None:
    """Content keys with the issues that own them, of the runs whose rows count."""
    paths = [f"{log}/keys/{RUN_COLUMN}={run.run_id}" for run in visible_runs(runs) if run.has_keys]
    return spark.read.schema("content_key string, iid long").parquet(*paths) if paths else None


def load_committed(
    spark: SparkSession, table: str, log: str, schema: T.StructType = ISSUE_SCHEMA
) -> DataFrame:
    """The rows of all committed runs with their ``processing_date``, columns in sorted order.

    Only folders that commits name are listed and read. A frame keeps its runs while others commit.
    """
    whole = T.StructType([*schema.fields]).add(PARTITION_COLUMN, "date")
    folders = [run.folder(table) for run in visible_runs(committed_runs(spark, log))]
    if folders:
        df = spark.read.schema(whole).option("basePath", table).parquet(*folders)
    else:
        df = spark.createDataFrame([], whole)
    return df.select(*sorted(whole.fieldNames()))


def remove_uncommitted(spark: SparkSession, table: str, log: str, before: datetime) -> list[str]:
    """Remove folders of runs that never committed or were replaced, all of whose files are older than ``before``.

    Choose ``before`` (UTC) earlier than the start of any run that may still be at work, and of any reader.
    """
    named = {run.folder(table).rsplit("/", 1)[1] for run in visible_runs(committed_runs(spark, log))}
    if not path_exists(spark, table):
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table)
    folder = F.regexp_extract("path", f"^(.*/({RUN_COLUMN}=[^/]*))/[^/]*$", 1)
    folders = files.groupBy(folder.alias("folder")).agg(F.max("modificationTime").alias("newest"))
    moment = F.lit(before.isoformat(" ") + "Z").cast("timestamp")
    old = [r.folder for r in folders.where((F.col("folder") != "") & (F.col("newest") < moment)).collect()]
    old = sorted(path for path in old if path.rsplit("/", 1)[1] not in named)
    for path in old:
        remove_path(spark, path)
    return old
