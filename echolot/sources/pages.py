"""Landed pages of raw tracker records."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from echolot.schemas import RAW_SCHEMA
from echolot.session import settings

# Fixed value: records per page of the tracker's interface.
PAGE_SIZE = 100

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def page_options(one_page_per_file: bool) -> dict[str, str]:
    """Reader options. Broken JSON fails the job instead of becoming a null row."""
    return {"multiLine": str(one_page_per_file).lower(), "mode": "FAILFAST"}


def read_issue_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    one_page_per_file: bool = False,
    schema: T.StructType | None = RAW_SCHEMA,
) -> DataFrame:
    """All records of all pages of a folder or of some files; an empty page gives no rows.

    A page is a JSON array. The usual landing file holds one page per line, which Spark
    splits by blocks; ``one_page_per_file`` reads files that are one array each. Without
    a schema the types are inferred, for exploration.
    """
    reader = spark.read.options(**page_options(one_page_per_file))
    if not isinstance(path, str) and not path:
        return spark.createDataFrame([], schema or RAW_SCHEMA)
    return (reader.schema(schema) if schema else reader).json(path if isinstance(path, str) else list(path))


def write_issue_pages(df: DataFrame, path: str, page_size: int = PAGE_SIZE, mode: str = "error") -> None:
    """Land records as pages, one per line; ``mode="append"`` adds files to a landing folder.

    Neighbouring rows of a task share a page, so this needs no shuffle and a page never
    exceeds ``page_size``. Python gets one page at a time, however many rows a task has.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = batch["record"].tolist()
            pages = [
                "[" + ",".join(records[i : i + page_size]) + "]"
                for i in range(0, len(records), page_size)
            ]
            yield pd.DataFrame({"value": pages})

    records = df.select(F.to_json(F.struct(*df.columns)).alias("record"))
    with settings(df.sparkSession, {ARROW_ROWS: str(page_size)}):
        records.mapInPandas(pack, "value string").write.mode(mode).text(path)
