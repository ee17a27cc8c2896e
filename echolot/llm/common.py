"""What the operators share: reading tables, stages in the shared folder, text keys."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import echolot
from echolot.session import remove_path, scratch_path

# Functions of this package travel with the task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(echolot)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Python gets rows, some of them with long texts, in smaller batches; a stage's write frees its
# shuffle files as soon as it is done.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
STAGE_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", **BATCH_CONF}

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a written table in the shared folder; later steps start from its files.

    A lost executor then repeats work from files, and nothing upstream runs twice. The shuffle files
    of the write go with it, since nobody reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = {key: spark.conf.get(key) for key in STAGE_CONF}
    for key, value in STAGE_CONF.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    table = spark.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Removes staged tables after their last reader is itself a written table."""
    for table in tables:
        remove_path(table.sparkSession, _paths.pop(table))


def text_or_empty(column: Column | str = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
