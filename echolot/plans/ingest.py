"""The batch ingest: landed pages to one partition of the processed table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from echolot.config import IngestConfig
from echolot.functions.iso_time import parse_strict
from echolot.operators.cleaning import (
    clean_issues,
    feedback_round,
    later_than,
    postprocess_issues,
    prepare_issues,
)
from echolot.operators.enrichment import enrich
from echolot.session import scratch_path
from echolot.operators.scoring import FAILURES, TooManyFailures
from echolot.schemas import RAW_SCHEMA
from echolot.sources import run_log as log
from echolot.sources.drift import BAD, RESCUED, TooManyBadRecords, read_drifting_pages, write_quarantine
from echolot.sources.landing import literal_path, record_files, unread_files
from echolot.sources.pages import read_issue_pages
from echolot.sources.run_state import RunState, load_run_state, save_run_state
from echolot.sources.tables import (
    PARTITION_COLUMN,
    known_keys,
    not_yet_written,
    write_known_keys,
    write_partition,
    write_stage,
)

Enricher = Callable[[DataFrame, IngestConfig], DataFrame]


@dataclass(frozen=True)
class RunSummary:
    """Row counts of one run and the state it leaves; ``files`` is None where all pages were read,
    ``failed`` counts the scorer calls that gave a default, ``bad`` the landed records that no one can use
    and ``rescued`` the new records with fields that went to the quarantine."""

    fetched: int
    new: int
    prepared: int
    saved: int
    state: RunState
    files: int | None = None
    failed: int = 0
    bad: int = 0
    rescued: int = 0


def process_issues(
    raw: DataFrame,
    cfg: IngestConfig,
    enricher: Enricher = enrich,
    prepared_rows: Observation | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Raw records to rows of the processed table: one shuffle, the de-duplication."""
    prepared = prepare_issues(clean_issues(raw, cfg, known), cfg)
    if prepared_rows is not None:
        prepared = prepared.observe(prepared_rows, F.count(F.lit(1)).alias("n"))
    return feedback_round(postprocess_issues(enricher(prepared, cfg), cfg), cfg)


def _rows_to_stage(raw: DataFrame, state: RunState, cfg: IngestConfig) -> DataFrame:
    """New records with ``_watermark``; records that no one can use stay among them."""
    usable = F.col(BAD).isNull()
    # A record that the reader marked as bad has no time to be parsed or compared.
    parsed = raw.withColumn("_watermark", F.when(usable, parse_strict(F.col(cfg.watermark_column))))
    return parsed.filter(F.when(usable, later_than(state.last_successful_run, "_watermark")).otherwise(True))


def run_batch(
    spark: SparkSession,
    landing: str,
    table: str,
    state_path: str,
    processing_date: date,
    cfg: IngestConfig | None = None,
    enricher: Enricher = enrich,
    mode: str | None = None,
    parity: bool = False,
    keys_path: str | None = None,
    one_page_per_file: bool = False,
    manifest: str | None = None,
    max_failed_share: float = 1.0,
    quarantine: str | None = None,
    max_bad_share: float = 1.0,
    run_log: str | None = None,
) -> RunSummary:
    """One incremental run.

    The new records become a Parquet stage first. JSON is parsed once then, and a lost
    executor repeats its part from the stage. The partition is written before the state,
    so a run that fails can simply be repeated. A later run of a day adds to the day's partition
    what it lacks; ``mode="overwrite"``, the default with ``parity``, replaces the partition. With
    ``keys_path`` issues are also de-duplicated against all earlier runs. With ``manifest`` only files that
    no earlier run has read are opened; the rows of the others are not later than the watermark, so the
    result is that of the full read. ``parity`` takes an earlier watermark and reads all files.

    Where the enricher counts failed scorer calls (``scoring.add_scored``), a run with more of them than
    ``max_failed_share`` of its rows ends with ``TooManyFailures`` before anything is published.

    Without ``quarantine`` a broken page ends the run. With it, pages may drift from the schema
    (``sources.drift``): records that cannot be used and fields that do not fit go to that table, and more bad
    records than ``max_bad_share`` of those read end the run with ``TooManyBadRecords`` before anything is
    published.

    With ``run_log`` the run is published in two steps (``sources.run_log``): rows, state and the lists of
    files and keys count together from the commit on, and ``load_committed`` reads them. State, manifest
    and keys then lie in the log: ``state_path`` is not used, ``manifest`` and ``keys_path`` only say
    whether to keep such lists.
    """
    if manifest and parity:
        raise ValueError("parity reads all landed files, so it takes no manifest")
    cfg = cfg or IngestConfig()
    mode = mode or ("overwrite" if parity else "append")
    partition = f"{table}/{PARTITION_COLUMN}={processing_date.isoformat()}"
    runs = log.committed_runs(spark, run_log) if run_log else []
    run = log.start_run(runs, processing_date, mode == "overwrite")
    state = run.state if run_log else load_run_state(spark, state_path)
    if run_log and manifest:
        manifest = log.committed_files(spark, run_log, runs)
    fetched_rows, new_rows = Observation("fetched"), Observation("new")
    files = unread_files(spark, landing, manifest) if manifest is not None else None
    pages = landing if files is None else [literal_path(file.path) for file in files]
    n_files = None if files is None else len(files)
    if quarantine:
        times = sorted({"created_at", "updated_at", cfg.watermark_column})
        required = sorted({"iid", "created_at", cfg.watermark_column})
        raw = read_drifting_pages(spark, pages, one_page_per_file, RAW_SCHEMA, required, times)
    else:
        raw = read_issue_pages(spark, pages, one_page_per_file).withColumn(BAD, F.lit(None).cast("string"))
    usable = F.col(BAD).isNull()
    counts = F.count_if(usable).alias("n"), F.count_if(~usable).alias("bad")
    new = _rows_to_stage(raw.observe(fetched_rows, *counts), state, cfg).observe(
        new_rows, counts[0], F.max("_watermark").alias("watermark")
    )
    staged = write_stage(new, scratch_path(spark, "new-issues")).drop("_watermark")
    n_fetched, n_new = fetched_rows.get["n"], new_rows.get["n"]
    n_bad = n_rescued = 0
    if quarantine:
        n_bad, n_rescued = fetched_rows.get["bad"], staged.where(F.size(RESCUED) > 0).count()
        if n_bad or n_rescued:
            write_quarantine(staged, quarantine)
        if n_bad > max_bad_share * (n_fetched + n_bad):
            raise TooManyBadRecords(n_bad, n_fetched + n_bad)
    staged = staged.where(usable).select(*RAW_SCHEMA.fieldNames())
    if n_new == 0:
        if run_log:
            if files:
                log.commit_run(spark, run_log, replace(run, rows=False, replaces=False), files)
        else:
            record_files(spark, files or [], manifest)
        return RunSummary(n_fetched, 0, 0, 0, state, n_files, bad=n_bad)

    known = None
    if keys_path and run_log:
        others = [earlier for earlier in runs if mode == "append" or earlier.day != processing_date]
        known = log.committed_keys(spark, run_log, others)
    elif keys_path:
        known = known_keys(spark, keys_path, PARTITION_COLUMN, processing_date, mode == "append")
    prepared_rows, saved_rows = Observation("prepared"), Observation("saved")
    issues = process_issues(staged, cfg, enricher, prepared_rows, known)
    failed = 0
    if FAILURES in issues.columns:
        failed_calls = Observation("failed")
        counted = issues.observe(failed_calls, F.count(F.lit(1)).alias("rows"), F.sum(FAILURES).alias("n"))
        issues = write_stage(counted.drop(FAILURES), scratch_path(spark, "enriched"))
        failed, rows = failed_calls.get["n"] or 0, failed_calls.get["rows"]
        if failed > max_failed_share * rows:
            raise TooManyFailures(failed, rows)
    if mode == "append":
        folders = [earlier.folder(table) for earlier in log.visible_runs(runs, processing_date)]
        issues = not_yet_written(issues, folders if run_log else partition)
    issues = issues.observe(
        saved_rows,
        F.count(F.lit(1)).alias("n"),
        F.max(cfg.watermark_column).alias("watermark"),
    )
    if run_log:
        log.write_run(issues, table, run)
        if keys_path:
            log.write_run_keys(spark, table, run_log, run)
    else:
        write_partition(issues, table, processing_date, mode)
        if keys_path:
            write_known_keys(spark, partition, keys_path, PARTITION_COLUMN, processing_date)

    watermark = (saved_rows if parity else new_rows).get["watermark"]
    saved = saved_rows.get["n"]
    new_state = RunState(watermark, n_new, saved)
    if run_log:
        log.commit_run(spark, run_log, replace(run, state=new_state, has_keys=bool(keys_path)), files or [])
    else:
        save_run_state(spark, state_path, new_state)
        record_files(spark, files or [], manifest)  # after the state: a file is read again rather than skipped
    return RunSummary(
        n_fetched, n_new, prepared_rows.get["n"], saved, new_state, n_files, failed, n_bad, n_rescued
    )
