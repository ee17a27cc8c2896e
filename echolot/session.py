"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024


def cluster_conf(input_bytes: int, partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """SQL settings for a job that reads ``input_bytes``.

    The shuffle starts with partitions of about ``partition_bytes`` and AQE merges the
    small ones and splits the skewed ones. ``parallelismFirst`` is off, so merging
    really aims at that size instead of at the number of cores.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def local_session(cpus: int = 8, memory: str = "8g", app: str = "echolot") -> SparkSession:
    """Session for tests and the bench on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Session settings for a write that runs inside, or for the start of a query, which keeps them."""
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for an intermediate table.

    It lies in the folder that ``spark.checkpoint.dir`` names, which all executors share.
    A local session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/echolot/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its file system, whichever one that is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a path on its file system, with all below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not exist yet; of two writers one fails."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
