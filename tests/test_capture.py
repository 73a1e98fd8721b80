import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsight.operators import capture as cap, upsert as up
from opsight.operators.runs import capture_run
from tests.conftest import plan_of, rows_of

SNAP = ("sid long, sql_id string, logon_time timestamp_ntz, population_date timestamp_ntz, "
        "instance_startup_date timestamp_ntz, fixed_table_sequence long, status string, command int, program string, "
        "user_id long, username string, schemaname string")
DAY = "2024-03-01T00:00:00"
OLD, NEW = "2024-02-01T00:00:00", "2024-03-01T00:00:00"
NOW = datetime(2024, 3, 1, 12)


@pytest.fixture(scope="module")
def snap(make):
    def build(rows):
        """(sid, statement, counter, instance start, ...) with defaults for the rest."""
        full = []
        for r in rows:
            sid, sql, seq, epoch, *rest = r
            extra = rest[0] if rest else {}
            full.append((
                sid, sql, extra.get("logon", DAY), extra.get("at", epoch[:11] + f"0{seq % 10}:00:00"), epoch, seq,
                extra.get("status", "ACTIVE"), extra.get("command", 3), extra.get("program", "report"),
                extra.get("user_id", sid), extra.get("username", f"U{sid}"), extra.get("schema", f"U{sid}"),
            ))
        return make(SNAP, full)

    return build


@pytest.fixture(scope="module")
def users(make):
    return make("user_id long, username string", [(1, "U1"), (2, "U2"), (3, "U3"), (9, "SYS")])


def test_eligibility(snap, users):
    df = snap([
        (1, "a", 1, NEW), (2, "a", 2, NEW, {"status": "INACTIVE"}), (4, "a", 3, NEW),
        (1, "b", 4, NEW, {"schema": "U4"}), (1, "c", 5, NEW, {"schema": "SYS"}),
        (1, "d", 6, NEW, {"program": "oracle (P001)"}), (1, "e", 7, NEW, {"program": None}),
        (3, "f", 8, NEW, {"program": "x busobj x"}), (3, "g", 9, NEW, {"program": "TOAD.exe", "command": 2}),
    ])
    assert rows_of(cap.eligible_sessions(df, users), "fixed_table_sequence") == [(1,), (7,), (8,), (9,)]
    assert rows_of(cap.eligible_sessions(df, users, cap.FIRST_RULES), "fixed_table_sequence") == [(8,)]
    assert rows_of(cap.eligible_sessions(df, users, cap.ALLOW_LIST_RULES), "fixed_table_sequence") == [(8,), (9,)]


def test_mark_is_that_of_the_newest_row_of_the_instance(snap):
    taken = snap([(1, "a", 50, OLD), (1, "b", 3, NEW, {"at": "2024-03-01T05:00:00"}),
                  (1, "c", 7, NEW, {"at": "2024-03-01T04:00:00"})])
    source = snap([(1, "x", n, NEW) for n in range(1, 9)])
    got = cap.changed_since_hwm(source, taken, datetime(2024, 3, 1))
    # the newest row has counter 3, although an older one has 7
    assert rows_of(got, "fixed_table_sequence") == [(4,), (5,), (6,), (7,), (8,)]
    assert cap.changed_since_hwm(source, taken.where("1 = 0"), datetime(2024, 3, 1)).count() == 0
    assert cap.changed_since_hwm(source, taken, datetime(2024, 2, 15)).count() == 0


def test_mark_needs_no_global_sort(snap):
    plan = plan_of(cap.changed_since_hwm(snap([]), snap([]), datetime(2024, 3, 1)))
    assert "Sort " not in plan and "Window" not in plan


def test_restart_takes_all_and_the_marker(snap, users):
    source = snap([
        (1, "a", 1, NEW), (2, "b", 2, NEW),
        (7, "ins", 3, NEW, {"username": "MONITOR", "command": 2, "schema": "MONITOR"}),
        (7, "sel", 4, NEW, {"username": "MONITOR", "command": 3, "schema": "MONITOR"}),
    ])
    init = cap.capture_with_epoch_reset(source, users, snap([(1, "z", 99, OLD)]), NOW, datetime(2024, 3, 1))
    assert rows_of(init, "fixed_table_sequence", "is_init") == [(1, True), (2, True), (3, True)]
    assert {r["population_date"] for r in init.collect()} == {NOW}
    empty = cap.capture_with_epoch_reset(source, users, snap([]), NOW, datetime(2024, 3, 1))
    assert empty.count() == 3
    later = cap.capture_with_epoch_reset(source, users, snap([(1, "z", 1, NEW)]), NOW, datetime(2024, 3, 1))
    assert rows_of(later, "fixed_table_sequence", "is_init") == [(2, False)]


def test_upsert_updates_and_inserts(snap):
    old = snap([(1, "a", 1, NEW), (2, "b", 2, NEW), (3, None, 3, NEW)])
    batch = snap([(1, "a", 11, NEW), (3, None, 13, NEW), (4, "c", 14, NEW)])
    got = up.upsert_sessions(old, batch)
    assert rows_of(got.fillna({"sql_id": "-"}), "sid", "sql_id", "fixed_table_sequence") == [
        (1, "a", 11), (2, "b", 2), (3, "-", 3), (3, "-", 13), (4, "c", 14),
    ]
    again = up.upsert_sessions(got.where("sql_id IS NOT NULL"), batch.where("sql_id IS NOT NULL"))
    assert rows_of(again) == rows_of(got.where("sql_id IS NOT NULL"))
    safe = up.upsert(old, batch, cap.SESSION_KEYS, null_safe_keys=True)
    assert rows_of(safe, "sid", "fixed_table_sequence") == [(1, 11), (2, 2), (3, 13), (4, 14)]


def test_a_target_row_matched_twice_is_an_error(snap):
    old = snap([(1, "a", 1, NEW)])
    twice = snap([(1, "a", 2, NEW), (1, "a", 3, NEW)])
    with pytest.raises(Exception, match="several batch rows"):
        up.upsert_sessions(old, twice).collect()
    # unmatched duplicates are simply added, as are rows with a NULL key
    assert up.upsert_sessions(snap([(9, "z", 1, NEW)]), twice).count() == 3
    nulls = snap([(1, None, 2, NEW), (1, None, 3, NEW)])
    assert up.upsert_sessions(old, nulls).count() == 3
    latest = up.upsert_sessions(old, twice.unionByName(nulls), "latest", [F.col("fixed_table_sequence").desc()])
    assert rows_of(latest, "fixed_table_sequence") == [(2,), (3,), (3,)]


def test_initial_batch_is_appended(snap, users):
    old = snap([(1, "a", 1, OLD)])
    source = snap([(1, "a", 1, NEW)])
    batch = cap.capture_with_epoch_reset(source, users, old, NOW, datetime(2024, 3, 1))
    assert up.upsert_sessions(old, batch).count() == 2


STATS = "sql_id string, sql_text string, instance_startup_date timestamp_ntz, population_date timestamp_ntz, executions long"


@pytest.fixture(scope="module")
def stats(make):
    return lambda rows: make(STATS, [(i, t, e, e, n) for i, t, e, n in rows])


def test_statement_upsert_is_per_instance_start(stats):
    old = stats([("a", "A", OLD, 1), ("a", "A", NEW, 2), ("b", "B", NEW, 3)])
    batch = stats([("a", "A", NEW, 20), ("c", "skip me", NEW, 30), ("d", None, NEW, 40)])
    want = [("a", 1), ("a", 20), ("b", 3)]
    assert rows_of(up.upsert_statement_stats(old, batch, "%skip%"), "sql_id", "executions") == want
    assert rows_of(up.upsert_statement_stats(old, batch, "%skip%", epoch=datetime(2024, 3, 1)), "sql_id", "executions") == want
    assert up.upsert_statement_stats(old, batch).count() == 5


def test_insert_only_merges(stats, make):
    got = up.insert_missing_stats(stats([("a", "A", OLD, 1)]), stats([("a", "A", NEW, 2), ("b", "B", NEW, 3)]))
    assert rows_of(got, "sql_id", "executions") == [("a", 1), ("b", 3)]
    schema = "user_id long, username string, created timestamp_ntz, default_tablespace string"
    dim = make(schema, [(1, "OLD_NAME", OLD, "X")])
    source = make(schema, [(1, "NEW_NAME", NEW, "USERS"), (2, "B", NEW, "TS_DATA"), (3, "C", NEW, "TEMP"),
                           (4, "D", "2024-02-10T23:59:59", "USERS"), (5, "E", NEW, "TSXDATA")])
    got = up.insert_missing_users(dim, source, datetime(2024, 2, 10).date(), ["USERS", "TS_%"])
    assert rows_of(got, "user_id", "username") == [(1, "OLD_NAME"), (2, "B"), (5, "E")]


def test_capture_run_returns_both_tables(snap, users, stats):
    sessions, statements = capture_run(
        snap([(1, "a", 5, NEW), (2, "b", 6, NEW)]), users, snap([(1, "a", 4, NEW)]),
        stats([("a", "A", NEW, 2)]), stats([("a", "A", NEW, 1)]), NOW, datetime(2024, 3, 1),
    )
    assert rows_of(sessions, "sid", "fixed_table_sequence") == [(1, 5), (2, 6)]
    assert rows_of(statements, "executions") == [(2,)]


def test_duplicates_and_delete(snap):
    df = snap([(1, "a", 1, NEW), (1, "a", 2, NEW), (2, None, 3, NEW), (2, None, 4, NEW), (3, "c", 5, NEW)])
    assert up.duplicates(df, ["sid", "sql_id"]).count() == 2
    left = up.delete_keys(df, df.where("sid = 1").select("sid").distinct())
    assert rows_of(left, "sid") == [(2,), (2,), (3,)]


def test_latest_per_key_limits_before_the_shuffle(snap):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.choice("ab"), n, NEW) for n in range(200)]
    df = cap.latest_per_key(snap(rows), ["sid", "sql_id"], [F.col("fixed_table_sequence").desc()])
    want = {}
    for sid, sql, n, _ in rows:
        want[sid, sql] = max(n, want.get((sid, sql), -1))
    assert {(r["sid"], r["sql_id"]): r["fixed_table_sequence"] for r in df.collect()} == want
    assert plan_of(df).count("WindowGroupLimit") >= 2
