"""Continuous snapshot capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from opsight.operators.upsert import newest_of_log
from opsight.sources.writers import BATCH, read_batches, write_batch
from opsight.streaming.common import held, start


def stream_capture(stream: DataFrame, path: str, keys: list[str], order: list[Column], checkpoint: str,
                   every: str | None = None) -> StreamingQuery:
    """Merge a stream of captured rows into the table kept at ``path``.

    Each micro-batch keeps its newest row per key and writes it as one batch of the log, so its cost
    does not grow with the table. Running a batch again replaces its folder and changes nothing.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            write_batch(newest_of_log(batch, keys, order), f"{path}/log", batch_id)

    return start(stream.writeStream.foreachBatch(store), checkpoint, every)


def merged_capture(spark: SparkSession, path: str, keys: list[str], order: list[Column],
                   upto: int | None = None) -> DataFrame:
    """The captured table, taking batches up to ``upto``: per key the first row in ``order``, rows with a
    NULL key all kept.

    Rows equal in ``order`` go by the latest batch, so where no two are equal the table is the same
    however the files were cut into batches.
    """
    rows = read_batches(spark, f"{path}/log")
    if upto is not None:
        rows = rows.where(F.col(BATCH) <= upto)
    return newest_of_log(rows, keys, [*order, F.col(BATCH).desc()]).drop(BATCH)
