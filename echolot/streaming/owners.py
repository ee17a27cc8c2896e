"""De-duplication of a stream by keyed state: who owns a title and description.

The state holds, for each content key (a digest), the issue that brought it first and the time of its
newest version: 48 bytes and no text. A micro-batch meets only the keys it holds, however long the
history is. The state lives in RocksDB on the executors and as changes in the checkpoint, so neither their
memory bounds it nor does a commit write it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from echolot.functions.iso_time import parse_strict
from echolot.operators.cleaning import content_key
from echolot.schemas import RAW_SCHEMA
from echolot.sources.pages import ARROW_ROWS

NONE = -(2**63)  # an issue without number or a time that is missing

#: Settings of a query with this state. A checkpoint keeps the provider and the number of partitions it began with.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state."
    "RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Whole records pass through Python, which holds a batch of them and the batch of its results.
    ARROW_ROWS: "200",
}


def _micros(column: str) -> Column:
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.coalesce(F.timestamp_diff("MICROSECOND", start, parse_strict(F.col(column))), F.lit(NONE))


def _owned(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """The one row of a content key that a micro-batch adds, if any. Keeps one row in memory."""
    owner, seen = state.get if state.exists else (None, None)
    best: tuple | None = None
    for batch in batches:
        rows = zip(batch["created"], batch["iid"], batch["updated"], batch["raw"], strict=True)
        for created, iid, updated, raw in rows:
            if owner is None:
                rank = (created, iid, -int(updated))
            elif iid == owner != NONE and updated > seen:
                rank = (-int(updated), created, iid)
            else:
                continue
            # The text decides last, so that a repeated batch makes the same choice.
            if best is None or (rank, raw) < best[:2]:
                best = (rank, raw, int(iid), int(updated))
    if best is not None:
        state.update(best[2:])
        yield pd.DataFrame({"raw": [best[1]]})


def first_owners(raw: DataFrame) -> DataFrame:
    """One row per title and description that the stream of raw records has not met, the earliest issue in
    its newest version, and later versions of that issue; null equals null.

    Copies that other issues bring, in this micro-batch or any later one, go, also those of issues without a
    number. A row that repeats a version of its owner goes too.
    """
    rows = raw.select(
        content_key().alias("content_key"),
        F.coalesce("iid", F.lit(NONE)).alias("iid"),
        _micros("created_at").alias("created"),
        _micros("updated_at").alias("updated"),
        F.to_json(F.struct(*RAW_SCHEMA.names)).alias("raw"),
    )
    kept = rows.groupBy("content_key").applyInPandasWithState(
        _owned, "raw string", "owner long, updated long", "append", GroupStateTimeout.NoTimeout
    )
    return kept.select(F.from_json("raw", RAW_SCHEMA).alias("r")).select("r.*")
