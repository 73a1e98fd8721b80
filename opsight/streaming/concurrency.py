"""Continuous session counts per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsight.operators.capture import latest_per_key
from opsight.operators.workload import PARALLEL_DEGREE
from opsight.sources.writers import BATCH, read_batches, write_batch
from opsight.streaming.common import start


def concurrency_windows(stream: DataFrame, width: str, lateness: str, factor: int = PARALLEL_DEGREE,
                        time: str = "population_date") -> DataFrame:
    """Sessions per window of the capture time, multiplied by the parallel degree.

    The watermark drops a window's state once it is ``lateness`` behind the newest row; rows later
    than that are not counted.
    """
    return (
        stream.withColumn("_time", F.col(time).cast("timestamp"))
        .withWatermark("_time", lateness)
        .groupBy(F.window("_time", width))
        .agg((F.count(F.lit(1)) * factor).alias("num_concur_sess"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), "num_concur_sess")
    )


def stream_concurrency(stream: DataFrame, path: str, width: str, lateness: str, checkpoint: str,
                       every: str | None = None) -> StreamingQuery:
    """Log every changed window count, batch by batch, at ``path``."""

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, path, batch_id)

    writer = concurrency_windows(stream, width, lateness).writeStream.outputMode("update").foreachBatch(store)
    return start(writer, checkpoint, every)


def current_concurrency(spark: SparkSession, path: str) -> DataFrame:
    """The last logged count of each window."""
    return latest_per_key(read_batches(spark, path), ["window_start"], [F.col(BATCH).desc()]).drop(BATCH)
