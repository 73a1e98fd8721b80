"""Shared pieces of the streaming forms."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream. Without an interval it takes everything that is there and stops."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


@contextmanager
def held(batch: DataFrame) -> Iterator[None]:
    """Keep a micro-batch while it is read more than once; lost blocks are read from the source again."""
    batch.persist()
    try:
        yield
    finally:
        batch.unpersist()
