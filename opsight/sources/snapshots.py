"""Snapshot tables laid out by day, so that a dated read opens only its days."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsight.functions.times import moment
from opsight.session import cut_lineage

DAY = "population_day"


def _marks(path: str) -> str:
    return f"{path.rstrip('/')}-marks"


def append_snapshot(df: DataFrame, path: str, time: str = "population_date", instance: str | None = None) -> None:
    """Append captured rows, one folder per day of the capture time.

    With an ``instance`` column the newest day of each instance in the batch goes to a small table beside the
    snapshot, after the rows: if only they were written, the marks show an older day, which is still right.
    """
    if instance is None:
        df.withColumn(DAY, F.col(time).cast("date")).write.mode("append").partitionBy(DAY).parquet(path)
        return
    dated = cut_lineage(df.withColumn(DAY, F.col(time).cast("date")))
    dated.write.mode("append").partitionBy(DAY).parquet(path)
    dated.groupBy(F.col(instance).alias("instance")).agg(F.max(DAY).alias("day")).coalesce(1).write.mode("append").parquet(
        _marks(path))


def read_newest(spark: SparkSession, path: str, epoch: datetime | Column) -> DataFrame:
    """The part of a snapshot that high-water marks are taken from: all days from the newest one of the given instance
    on, and of the newest instance if that one is older.

    Any newest row of either instance is among them, so marks come out as from the whole snapshot. The day is looked
    up in the marks beside it, a row per instance and batch, and prunes the folders when the read is planned. A snapshot
    without a dated mark of theirs is read whole.
    """
    days = spark.read.parquet(_marks(path)).groupBy("instance").agg(F.max("day").alias("day"))
    day = F.coalesce("day", F.lit(date.min.isoformat()).cast("date"))
    own, last = days.agg(
        F.max(F.when(F.col("instance") == moment(epoch), day)), F.max_by(day, "instance")).first()
    known = [d for d in (own, last) if d is not None]
    return read_snapshot(spark, path, since=min(known) if known and min(known) > date.min else None)


def read_snapshot(spark: SparkSession, path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """The snapshot of the days from ``since`` to ``until``, both included."""
    out = spark.read.parquet(path)
    if since is not None:
        out = out.where(F.col(DAY) >= F.lit(since))
    if until is not None:
        out = out.where(F.col(DAY) <= F.lit(until))
    return out.drop(DAY)
