import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from opsight.operators import capture as cap, upsert as up
from opsight.session import scratch_path
from opsight.sources.readers import stream_files
from opsight.sources.writers import read_batches, write_batch
from opsight.streaming.capture import merged_capture, stream_capture
from opsight.streaming.changed import changed_rows, seed_marks, stream_changed_rows
from opsight.streaming.concurrency import current_concurrency, stream_concurrency
from tests.conftest import rows_of

SCHEMA = ("sid long, sql_id string, logon_time timestamp_ntz, population_date timestamp_ntz, "
          "instance_startup_date timestamp_ntz, fixed_table_sequence long")


@pytest.fixture
def arriving(spark, make):
    """Files that arrive one after the other, and a stream that takes one per batch."""

    def build(parts):
        path = scratch_path(spark, "arriving")
        frames = []
        for part in parts:
            df = make(SCHEMA, part)
            df.coalesce(1).write.mode("append").parquet(path)
            frames.append(df)
        return stream_files(spark, path, frames[0].schema, files_per_trigger=1), frames

    return build


def _some(seed, files=4, n=30):
    rng = random.Random(seed)
    base = datetime(2024, 3, 1)
    out, seq = [], 0
    for _ in range(files):
        part = []
        for _ in range(n):
            seq += 1
            at = (base + timedelta(minutes=seq * 7)).isoformat()
            part.append((rng.randrange(4), rng.choice([None, "a", "b"]), base.isoformat(), at, base.isoformat(), seq))
        out.append(part)
    return out


def test_stream_capture_equals_merging_batch_by_batch(spark, arriving):
    stream, frames = arriving(_some(1))
    path = scratch_path(spark, "capture")
    order = [F.col("fixed_table_sequence").desc()]
    stream_capture(stream, path, cap.SESSION_KEYS, order, f"{path}/c").awaitTermination()
    table = frames[0].where("1 = 0")
    for f in frames:
        table = up.upsert_sessions(table, f, "latest", order)
    got = merged_capture(spark, path, cap.SESSION_KEYS, order)
    assert read_batches(spark, f"{path}/log").select("batch_id").distinct().count() == len(frames)
    assert rows_of(got.fillna({"sql_id": "-"})) == rows_of(table.fillna({"sql_id": "-"}))


def test_writing_a_batch_again_changes_nothing(spark, make):
    path = scratch_path(spark, "replay")
    df = make(SCHEMA, _some(2, 1)[0])
    order = [F.col("fixed_table_sequence").desc()]
    for _ in range(2):
        write_batch(up.newest_of_log(df, cap.SESSION_KEYS, order), f"{path}/log", 0)
    once = rows_of(merged_capture(spark, path, cap.SESSION_KEYS, order).fillna({"sql_id": "-"}))
    assert len(once) == len(set(once))


def test_a_late_row_does_not_replace_a_newer_one(spark, arriving):
    at = "2024-03-01T00:00:00"

    def row(seq, sql_id="a"):
        return (1, sql_id, at, at, at, seq)

    stream, _ = arriving([[row(9), row(2, None)], [row(3), row(5, "b")], [row(7), row(1, None), row(6, "b")]])
    path, order = scratch_path(spark, "late"), [F.col("fixed_table_sequence").desc()]
    stream_capture(stream, path, cap.SESSION_KEYS, order, f"{path}/c").awaitTermination()
    got = merged_capture(spark, path, cap.SESSION_KEYS, order)
    assert sorted((r["sql_id"] or "", r["fixed_table_sequence"]) for r in got.collect()) == [
        ("", 1), ("", 2), ("a", 9), ("b", 6)]
    first = merged_capture(spark, path, cap.SESSION_KEYS, order, upto=0)
    assert sorted(r["fixed_table_sequence"] for r in first.collect()) == [2, 9]


def test_stream_concurrency_equals_the_batch_count(spark, arriving):
    stream, frames = arriving(_some(3))
    path = scratch_path(spark, "concurrency")
    stream_concurrency(stream, f"{path}/log", "1 hour", "1 hour", f"{path}/c").awaitTermination()
    every = frames[0]
    for f in frames[1:]:
        every = every.unionByName(f)
    want = every.groupBy(F.date_trunc("hour", "population_date").cast("timestamp_ntz").alias("w")).agg((F.count("*") * 24).alias("n"))
    assert rows_of(current_concurrency(spark, f"{path}/log"), "window_start", "num_concur_sess") == rows_of(want, "w", "n")


def test_marks_rise_per_instance_start(spark, arriving):
    def row(seq, epoch):
        return (1, "a", "2024-03-01T00:00:00", "2024-03-01T00:00:00", f"2024-03-0{epoch}T00:00:00", seq)

    stream, _ = arriving([
        [row(5, 1), row(9, 1)],
        [row(9, 1), row(10, 1), row(1, 2)],       # a new start with lower counters
        [row(7, 1), row(2, 2), row(1, 2)],        # late rows of both
        [row(11, 1), row(3, 2)],
    ])
    path = scratch_path(spark, "changed")
    stream_changed_rows(stream, path, f"{path}/c").awaitTermination()
    got = [(r[0].day, r[1]) for r in rows_of(changed_rows(spark, path), "instance_startup_date", "fixed_table_sequence")]
    assert sorted(got) == [(1, 5), (1, 9), (1, 10), (1, 11), (2, 1), (2, 2), (2, 3)]


def test_marks_can_be_given(spark, arriving, make):
    stream, _ = arriving([[(1, "a", "2024-03-01T00:00:00", "2024-03-01T00:00:00", "2024-03-01T00:00:00", n) for n in range(6)]])
    path = scratch_path(spark, "seeded")
    seed_marks(make("instance_startup_date timestamp_ntz, mark long", [("2024-03-01T00:00:00", 3)]), path)
    stream_changed_rows(stream, path, f"{path}/c").awaitTermination()
    assert rows_of(changed_rows(spark, path), "fixed_table_sequence") == [(4,), (5,)]
