"""Back-fill of a column that older partitions of the processed table lack.

Which partitions lack it is told by the footers of their files; the others are neither read nor
written. A partition is replaced as a whole when the job commits, so a run that fails before leaves it
as it was and a repeated run goes on with what is left. Replaced files make the next merge of a versioned
snapshot build it anew.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from echolot.sources.landing import list_files, literal_path
from echolot.sources.tables import BATCH_COLUMN, PARTITION_COLUMN


def partitions_without(spark: SparkSession, table: str, column: str) -> dict[str, str]:
    """Folders of the table's partitions none of whose files has the column, with their schema as JSON.

    Spark merges the footers of a folder's files in a job. A partition that has the column in some of its files
    counts as filled, since the rows of the others may lack it on purpose.
    """
    files = list_files(spark, table).where("path like '%.parquet'").select("path")
    folders = sorted({row.path.rsplit("/", 1)[0] for row in files.toLocalIterator()})
    without = {}
    for folder in folders:
        schema = spark.read.option("mergeSchema", "true").parquet(literal_path(folder)).schema
        if column not in schema.names:
            without[folder] = schema.json()
    return without


def backfill(
    spark: SparkSession, table: str, column: str, fill: Callable[[DataFrame], DataFrame]
) -> list[str]:
    """Rewrite the partitions that lack ``column`` by ``fill``, which adds it; returns their folders.

    Partitions of one schema and depth are one job. It has no shuffle: a file's rows stay together, in one
    file or several of the partition that they came from.
    """
    alike: dict[tuple[str, bool], list[str]] = defaultdict(list)
    for folder, schema in partitions_without(spark, table, column).items():
        alike[schema, f"/{BATCH_COLUMN}=" in folder].append(folder)
    for (_, in_batches), folders in alike.items():
        paths = [literal_path(folder) for folder in folders]
        rows = fill(spark.read.option("basePath", table).parquet(*paths))
        if column not in rows.columns:
            raise ValueError(f"the fill adds no column {column}")
        levels = [PARTITION_COLUMN, *([BATCH_COLUMN] if in_batches else [])]
        writer = rows.write.partitionBy(*levels).mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").parquet(table)
    return sorted(folder for folders in alike.values() for folder in folders)
