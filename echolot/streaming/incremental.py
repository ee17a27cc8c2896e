"""Incremental ingest of newly landed pages with Structured Streaming."""

from __future__ import annotations

import json
import zlib
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from echolot.config import IngestConfig
from echolot.functions.iso_time import parse_strict
from echolot.operators.cleaning import exclude_ids, new_issues
from echolot.operators.enrichment import enrich
from echolot.plans.ingest import Enricher, process_issues
from echolot.schemas import RAW_SCHEMA
from echolot.session import settings
from echolot.sources.pages import page_options
from echolot.sources.tables import (
    BATCH_COLUMN,
    PARTITION_COLUMN,
    known_keys,
    write_known_keys,
    write_partition,
)
from echolot.streaming.owners import STATE_CONF, first_owners


def _batch_number(spark: SparkSession, checkpoint: str, number: int) -> int:
    """A number for a micro-batch that no other checkpoint gives."""
    query = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
    return zlib.crc32(query.encode()) * 2**31 + number


def run_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    processing_date: date,
    cfg: IngestConfig | None = None,
    enricher: Enricher = enrich,
    watermark: datetime | None = None,
    keys_path: str | None = None,
    max_files_per_trigger: int | None = None,
    one_page_per_file: bool = False,
    dedupe_by_state: bool = False,
) -> StreamingQuery:
    """Process the files that landed since the last call, then stop.

    The checkpoint remembers which files were read. Each micro-batch replaces its own
    partition ``(processing_date, ingest_batch)``, so a batch repeated after a failure
    leaves one result. The batch's number holds the id of the checkpoint's query, so another
    checkpoint never replaces it.

    With ``dedupe_by_state`` issues are also de-duplicated against all earlier batches of the
    checkpoint, by state that grows by one small entry per distinct text; no batch reads what
    earlier ones wrote. ``keys_path`` does it with a table of keys instead, which several streams and
    batch runs can share and which every batch reads whole.
    """
    if dedupe_by_state and keys_path:
        raise ValueError("de-duplicate by state or by a table of keys, not by both")
    cfg = cfg or IngestConfig()

    def newer(rows: DataFrame) -> DataFrame:
        parsed = rows.withColumn("_watermark", parse_strict(F.col(cfg.watermark_column)))
        return new_issues(parsed, watermark, "_watermark").drop("_watermark")

    def ingest(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        batch_id = _batch_number(session, checkpoint, number)
        known = known_keys(session, keys_path, BATCH_COLUMN, batch_id) if keys_path else None
        issues = process_issues(batch, cfg, enricher, known=known)
        write_partition(issues, table, processing_date, batch=batch_id)
        if keys_path:
            day = f"{PARTITION_COLUMN}={processing_date.isoformat()}"
            partition = f"{table}/{day}/{BATCH_COLUMN}={batch_id}"
            write_known_keys(session, partition, keys_path, BATCH_COLUMN, batch_id)

    reader = spark.readStream.schema(RAW_SCHEMA).options(**page_options(one_page_per_file))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # Row-local, so it runs before the state: an excluded issue owns no text.
    rows = newer(reader.json(landing))
    if dedupe_by_state:
        rows = first_owners(exclude_ids(rows, cfg))
    with settings(spark, STATE_CONF if dedupe_by_state else {}):
        return (
            rows.writeStream.foreachBatch(ingest)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
