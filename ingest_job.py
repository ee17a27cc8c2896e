"""Nightly ingest as a Spark job.

    spark-submit --py-files echolot.zip ingest_job.py \\
        --landing s3a://bucket/landing --table s3a://bucket/issues --state s3a://bucket/state

Exit code 0 after a run, also one without new issues; 1 after a failure.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys
from datetime import UTC, date, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from echolot.config import IngestConfig
from echolot.plans.ingest import run_batch
from echolot.session import cluster_conf

logger = logging.getLogger("ingest")


def config_file(path: str) -> IngestConfig:
    """Settings of a run; the file names fields of ``IngestConfig``, lists stand for tuples."""

    def frozen(value):
        return tuple(map(frozen, value)) if isinstance(value, list) else value

    settings = json.loads(Path(path).read_text(encoding="utf-8"))
    return IngestConfig(**{name: frozen(value) for name, value in settings.items()})


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Ingest newly landed issue pages.")
    parser.add_argument("--landing", required=True, help="folder of landed pages")
    parser.add_argument("--table", required=True, help="processed table")
    parser.add_argument("--state", help="folder of the run state; needed without --run-log")
    parser.add_argument("--run-log", help="log of commits: rows and state of a run are published together")
    parser.add_argument("--keys", help="content keys, to de-duplicate against earlier runs")
    parser.add_argument("--date", type=date.fromisoformat, help="processing date, UTC today if unset")
    parser.add_argument("--mode", choices=("overwrite", "append"))
    parser.add_argument("--manifest", help="list of files read so far, to open only new ones")
    parser.add_argument("--config", type=config_file, default=IngestConfig(), help="JSON file of settings")
    parser.add_argument("--parity", action="store_true", help="watermark and partitions as the original has them")
    parser.add_argument("--max-failed-share", type=float, default=1.0, help="of failed scorer calls")
    parser.add_argument("--quarantine", help="table of drifted fields and bad records, which else end the run")
    parser.add_argument("--max-bad-share", type=float, default=1.0, help="of landed records")
    parser.add_argument("--page-files", action="store_true", help="each file is one page")
    parser.add_argument("--input-bytes", type=int, default=0, help="expected size of new pages")
    args = parser.parse_args(argv)
    if not (args.state or args.run_log):
        parser.error("--state or --run-log is needed")
    return args


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = arguments(argv)
    spark = SparkSession.builder.appName("issue-ingest").getOrCreate()
    for key, value in cluster_conf(args.input_bytes).items():
        spark.conf.set(key, value)
    try:
        run = run_batch(
            spark,
            args.landing,
            args.table,
            args.state or "",
            args.date or datetime.now(UTC).date(),
            mode=args.mode,
            cfg=args.config,
            parity=args.parity,
            keys_path=args.keys,
            manifest=args.manifest,
            max_failed_share=args.max_failed_share,
            quarantine=args.quarantine,
            max_bad_share=args.max_bad_share,
            run_log=args.run_log,
            one_page_per_file=args.page_files,
        )
    except Exception:
        logger.exception("ingest failed; the run state is unchanged")
        return 1
    logger.info(
        "fetched %d, new %d, prepared %d, saved %d, failed scorer calls %d, bad records %d; next run starts after %s",
        run.fetched,
        run.new,
        run.prepared,
        run.saved,
        run.failed,
        run.bad,
        run.state.last_successful_run,
    )
    return 0


if __name__ == "__main__":
    sys.exit(main())
