"""Label vocabulary files: one label a line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from echolot.functions.text import PYTHON_WHITE_SPACE, strip


def load_label_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Labels of a vocabulary file, without blank lines and lines that start with #."""
    label = strip(F.col("value"), PYTHON_WHITE_SPACE).alias("label")
    labels = spark.read.text(path).select(label)
    return labels.filter((F.col("label") != "") & ~F.col("label").startswith("#"))


def vocabulary_frame(spark: SparkSession, labels: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(label,) for label in labels], "label string")
