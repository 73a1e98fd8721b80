"""Sinks: append, create-once, complete versions and batch logs.

Every sink writes files through Spark's own committer, so a lost executor or a repeated batch
leaves no half-written result behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "batch_id"


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def create_once(df: DataFrame, path: str) -> None:
    """Create a table from a query; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Empty and load again. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def _finished(spark: SparkSession, pattern: str) -> list:
    """Folders that fit the pattern and whose write has finished."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.globStatus(marker) or [])


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers whose write has finished."""
    done = _finished(spark, f"{path}/version=*")
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def latest_version(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version, 0 without one."""
    return max(_versions(spark, path), default=0)


def write_version(df: DataFrame, path: str, number: int | None = None) -> int:
    """Write ``df`` whole as the next version. It may be derived from the version being replaced:
    readers move on only when the new one is complete."""
    if number is None:
        number = latest_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    return number


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The given version, or the newest complete one."""
    if number is None:
        number = latest_version(spark, path)
        if number == 0:
            raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(f"{path}/version={number}")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One batch of a log in its own folder; writing the same batch again replaces it.

    The cost follows the batch and not the table: nothing already stored is read or rewritten.
    """
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """One batch of a log, None where it was not written."""
    folder = f"{path}/{BATCH}={batch_id}"
    return spark.read.parquet(folder) if _finished(spark, folder) else None


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches of a log, with their number in ``batch_id``."""
    return spark.read.option("basePath", path).parquet(path).withColumn(BATCH, F.col(BATCH).cast("bigint"))
