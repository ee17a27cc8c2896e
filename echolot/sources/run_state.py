"""State of the incremental run: one small JSON record, on any file system Spark reads."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.config import FIRST_WATERMARK
from echolot.functions.iso_time import parse_lenient, to_iso
from echolot.schemas import STATE_SCHEMA
from echolot.session import path_exists


@dataclass(frozen=True)
class RunState:
    last_successful_run: datetime | None
    last_fetched_issues: int = 0
    total_issues_processed: int = 0


FIRST_RUN = RunState(FIRST_WATERMARK)


def state_frame(fetched: DataFrame, processed: DataFrame, parity: bool = False) -> DataFrame:
    """New run state: watermark and row counts of what was fetched and processed.

    The watermark is the newest fetched ``created_at``, so excluded rows are not read
    again. ``parity`` takes the newest processed one instead.
    """
    columns = F.max("created_at").alias("watermark"), F.count(F.lit(1)).alias("n")
    both = (
        fetched.agg(*columns)
        .withColumn("stage", F.lit("fetched"))
        .unionByName(processed.agg(*columns).withColumn("stage", F.lit("processed")))
    )

    def of_stage(stage: str, column: str) -> Column:
        return F.max(F.when(F.col("stage") == stage, F.col(column)))

    return both.agg(
        to_iso(of_stage("processed" if parity else "fetched", "watermark")).alias(
            "last_successful_run"
        ),
        of_stage("fetched", "n").alias("last_fetched_issues"),
        of_stage("processed", "n").alias("total_issues_processed"),
    )


def load_run_state(spark: SparkSession, path: str) -> RunState:
    """The last recorded state.

    A missing state is the first run; an unreadable one has no watermark, so the next run
    reads everything.
    """
    if not path_exists(spark, path):
        return FIRST_RUN
    records = spark.read.schema(STATE_SCHEMA).option("multiLine", "true").json(path)
    newest = records.orderBy(F.desc_nulls_last("recorded_at")).select(
        parse_lenient(F.col("last_successful_run")).alias("watermark"),
        F.coalesce("last_fetched_issues", F.lit(0)).alias("fetched"),
        F.coalesce("total_issues_processed", F.lit(0)).alias("processed"),
    )
    row = newest.first()
    if row is None:
        return RunState(None)
    return RunState(row.watermark, row.fetched, row.processed)


def save_run_state(spark: SparkSession, path: str, state: RunState) -> None:
    """Record a state. Records are only added, so a lost run never damages the last one."""
    watermark = state.last_successful_run
    row = (
        watermark.strftime("%Y-%m-%dT%H:%M:%S.%fZ") if watermark else None,
        state.last_fetched_issues,
        state.total_issues_processed,
        datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
    )
    frame = spark.createDataFrame([row], STATE_SCHEMA).coalesce(1)
    frame.write.mode("append").option("ignoreNullFields", "false").json(path)
