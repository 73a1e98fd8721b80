"""Streaming forms over the event file, run until everything present is read."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from opsight.operators.capture import SESSION_KEYS
from opsight.plans.registry import query
from opsight.session import scratch_path
from opsight.sources import derived as t
from opsight.sources.readers import stream_files
from opsight.streaming.capture import merged_capture, stream_capture
from opsight.streaming.changed import changed_rows, seed_marks, stream_changed_rows
from opsight.streaming.concurrency import current_concurrency, stream_concurrency

SPLIT = datetime.fromisoformat(t.SPLIT)


def _sessions(tb, files: int = 1):
    """The session snapshot as a stream; with several files each one is a batch."""
    events = tb.spark.read.parquet(f"{tb.sf_dir}/events.parquet")
    if files == 1:
        events = stream_files(tb.spark, tb.sf_dir, events.schema, glob="events.parquet")
    else:
        path = scratch_path(tb.spark, "arriving")
        events.repartition(files).write.parquet(path)
        events = stream_files(tb.spark, path, events.schema, files_per_trigger=1)
    return t.logical(tb.spark, tb.sf_dir, t.session_snap, {"events": events})


@query("q60_stream_capture", [t.session_snap], """
    SELECT * EXCLUDE (r) FROM (
      SELECT *, row_number() OVER (PARTITION BY sid, sql_id, logon_time ORDER BY fixed_table_sequence DESC) AS r
      FROM session_snap) q WHERE r = 1 OR sql_id IS NULL""")
def capture(tb):
    path = scratch_path(tb.spark, "stream-capture")
    order = [F.col("fixed_table_sequence").desc()]
    stream_capture(_sessions(tb, files=4), path, SESSION_KEYS, order, f"{path}/checkpoint").awaitTermination()
    return merged_capture(tb.spark, path, SESSION_KEYS, order)


@query("q61_stream_concurrency", [t.session_snap], """
    SELECT population_date AS window_start, count(*) * 24 AS num_concur_sess FROM session_snap GROUP BY 1""")
def concurrency(tb):
    path = scratch_path(tb.spark, "stream-concurrency")
    stream_concurrency(
        _sessions(tb), f"{path}/log", "1 hour", "2 hours", f"{path}/checkpoint"
    ).awaitTermination()
    return current_concurrency(tb.spark, f"{path}/log")


@query("q62_stream_changed_rows", [t.session_snap], f"""
    SELECT s.* FROM session_snap s
    LEFT JOIN (SELECT instance_startup_date AS e, max(fixed_table_sequence) AS mark FROM session_snap
               WHERE population_date < TIMESTAMP '{t.SPLIT}' GROUP BY 1) m ON s.instance_startup_date = m.e
    WHERE m.mark IS NULL OR s.fixed_table_sequence > m.mark""")
def changed(tb):
    path = scratch_path(tb.spark, "stream-changed")
    known = tb.session_snap.where(F.col("population_date") < F.lit(t.SPLIT).cast("timestamp_ntz"))
    seed_marks(known.groupBy("instance_startup_date").agg(F.max("fixed_table_sequence").alias("mark")), path)
    stream_changed_rows(_sessions(tb), path, f"{path}/checkpoint").awaitTermination()
    return changed_rows(tb.spark, path)
