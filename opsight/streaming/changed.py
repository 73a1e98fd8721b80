"""Continuous change detection by a rising counter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsight.sources.writers import BATCH, read_batch, read_batches, write_batch
from opsight.streaming.common import held, start


def stream_changed_rows(stream: DataFrame, path: str, checkpoint: str, epoch: str = "instance_startup_date",
                        counter: str = "fixed_table_sequence", every: str | None = None) -> StreamingQuery:
    """Keep the rows whose counter is above the highest one seen before for their instance start.

    A new instance start has no mark, so all its rows pass. Rows of an older start are held against
    that start's own mark and leave the others alone. Rows go to ``path/rows`` and the marks after the
    batch, one row per instance start, to ``path/marks``. Both are written under the batch number and
    a batch reads only the marks of the one before, so repeating it gives the same result.
    """
    spark = stream.sparkSession

    def store(batch: DataFrame, batch_id: int) -> None:
        marks = read_batch(spark, f"{path}/marks", batch_id - 1)
        if marks is None and batch_id > 0:
            raise FileNotFoundError(f"marks of batch {batch_id - 1} are missing in {path}")
        raised = batch.groupBy(epoch).agg(F.max(counter).alias("mark"))
        fresh = batch
        if marks is not None:
            known = marks.withColumnRenamed(epoch, "_epoch")
            fresh = (
                batch.join(known, F.col(epoch).eqNullSafe(F.col("_epoch")), "left")
                .where(F.col("mark").isNull() | (F.col(counter) > F.col("mark")))
                .select(*batch.columns)
            )
            raised = marks.unionByName(raised).groupBy(epoch).agg(F.max("mark").alias("mark"))
        with held(batch):
            write_batch(fresh, f"{path}/rows", batch_id)
            write_batch(raised, f"{path}/marks", batch_id)

    return start(stream.writeStream.foreachBatch(store), checkpoint, every)


def seed_marks(marks: DataFrame, path: str) -> None:
    """Start from known marks (columns: the instance start and ``mark``) instead of none."""
    write_batch(marks, f"{path}/marks", -1)


def changed_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_batches(spark, f"{path}/rows").drop(BATCH)
