"""Bring-your-own model: a Python scorer as a column.

Only the scorer's input columns travel to Python, in Arrow batches; the other columns
stay in the JVM and no join brings the result back.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import echolot

# The functions of this package travel with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(echolot)

# A scorer takes rows (one tuple of inputs each) and returns one value per row.
Scorer = Callable[[list[tuple]], Sequence[Any]]


# Counts the failed scorer calls of a row until the run has added them up.
FAILURES = "_failed_scores"


class TooManyFailures(RuntimeError):
    """More scorer calls failed than the run permits."""

    def __init__(self, failed: int, rows: int) -> None:
        super().__init__(f"{failed} scorer calls failed over {rows} rows")
        self.failed, self.rows = failed, rows


def _score_chunk(scorer: Scorer, rows: list[tuple], default: Any) -> list[tuple[Any, str | None]]:
    """Values and errors. Rows are scored together; if that fails, one by one, with the default for the bad rows."""
    try:
        values = list(scorer(rows))
        if len(values) != len(rows):
            raise ValueError("the scorer returned another number of values")
        return [(value, None) for value in values]
    except Exception as error:
        if len(rows) == 1:
            return [(default, f"{type(error).__name__}: {error}"[:500])]
        return [result for row in rows for result in _score_chunk(scorer, [row], default)]


def scored_results(
    *inputs: Column | str,
    make_scorer: Callable[[], Scorer],
    returns: T.DataType | str,
    default: Any,
    skip_null: bool = False,
    batch_rows: int = 10,
    pause_s: float = 0.0,
) -> Column:
    """``struct<value, error>`` of a scorer over the input columns; ``error`` is null where it gave the value.

    ``make_scorer`` runs once per task, which is where a model is loaded. A row that
    fails gets ``default``. ``skip_null`` leaves rows with a null input null. ``pause_s``
    waits after each call, for models behind a quota.
    """
    value = returns if isinstance(returns, str) else returns.simpleString()

    @F.pandas_udf(f"value {value}, error string")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for batch in batches:
            known = batch.astype(object).where(batch.notna(), None)
            rows = list(known.itertuples(index=False, name=None))
            results: list[tuple[Any, str | None]] = [(None, None)] * len(rows)
            wanted = [
                i for i, row in enumerate(rows) if not (skip_null and any(v is None for v in row))
            ]
            for start in range(0, len(wanted), batch_rows):
                chunk = wanted[start : start + batch_rows]
                found = _score_chunk(scorer, [rows[i] for i in chunk], default)
                for i, result in zip(chunk, found, strict=True):
                    results[i] = result
                if pause_s:
                    time.sleep(pause_s)
            values, errors = zip(*results, strict=True) if results else ((), ())
            yield pd.DataFrame(
                {"value": pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)}
            )

    return run(F.struct(*inputs))


def scored(*inputs: Column | str, **options: Any) -> Column:
    """Values of a scorer over the input columns; options are those of ``scored_results``."""
    return scored_results(*inputs, **options)["value"]


def add_scored(df: DataFrame, name: str, results: Column) -> DataFrame:
    """The scorer's values as column ``name``, its failures added to the row's count.

    ``run_batch`` adds the counts up while it writes and refuses to publish too many.
    """
    df = df.withColumn("_result", results)
    before = F.col(FAILURES) if FAILURES in df.columns else F.lit(0)
    failed = F.col("_result.error").isNotNull().cast("long")
    return df.withColumns({name: F.col("_result.value"), FAILURES: before + failed}).drop("_result")
