import random

import pytest

from opsight.operators import statements as st
from tests.conftest import plan_of, rows_of

DAY = "2024-03-01T00:00:00"


@pytest.fixture(scope="module")
def data(make):
    rng = random.Random(4)

    def sid():
        return rng.choice([None, 1, 2, 3, 4, 5])

    snap = [(sid(), rng.choice([None, "a", "b", "c"]), DAY, f"2024-03-01T0{rng.randrange(9)}:00:00", n) for n in range(60)]
    sessions = [(1, "ACTIVE"), (2, "ACTIVE"), (2, "ACTIVE"), (None, "ACTIVE"), (3, "INACTIVE"), (3, "INACTIVE"), (4, "KILLED")]
    stats = [("a", 1), ("a", 2), ("b", 3), ("d", 4), (None, 5)]
    return (
        make("sql_id string, n long", stats),
        make("sid long, sql_id string, logon_time timestamp_ntz, population_date timestamp_ntz, "
             "fixed_table_sequence long", snap),
        make("sid long, status string", sessions),
    )


def _sql(spark, data, query):
    for name, df in zip(("stats", "snap", "sessions"), data):
        df.createOrReplaceTempView(name)
    return sorted(tuple(r) for r in spark.sql(query).collect())


def _expanded(df):
    return rows_of(st.expand(df), "sql_id", "n")


def test_expand_deals_out_many_copies(make):
    df = make("sql_id string, n long, matches long", [("a", 1, 7), ("b", 2, 0), ("c", 3, None), ("d", 4, 1), ("e", 5, 3)])
    assert rows_of(st.expand(df, portion=3), "sql_id") == [("a",)] * 7 + [("d",)] + [("e",)] * 3
    large = st.expand(make("sql_id string, matches long", [("a", 3_000_000_000)]))
    assert large.limit(200_000).count() == 200_000


TRACKED = "(SELECT DISTINCT sid, sql_id, logon_time FROM snap)"


def test_tracked(spark, data):
    stats, snap, _ = data
    assert _expanded(st.stats_of_tracked(stats, snap)) == _sql(
        spark, data, f"SELECT s.* FROM stats s JOIN {TRACKED} k ON s.sql_id = k.sql_id")
    assert rows_of(st.stats_of_tracked(stats, snap, "distinct")) == _sql(
        spark, data, "SELECT * FROM stats WHERE sql_id IN (SELECT sql_id FROM snap WHERE sql_id IS NOT NULL)")


@pytest.mark.parametrize("how,query", [
    ("not_in", "SELECT s.* FROM stats s JOIN snap k ON s.sql_id = k.sql_id WHERE k.sid NOT IN "
               "(SELECT sid FROM sessions WHERE status = 'ACTIVE' AND sid IS NOT NULL)"),
    ("anti", f"SELECT s.* FROM stats s JOIN {TRACKED} k ON s.sql_id = k.sql_id LEFT ANTI JOIN "
             "(SELECT sid FROM sessions WHERE status = 'ACTIVE') a ON k.sid = a.sid"),
    ("inactive", "SELECT s.* FROM stats s JOIN snap k ON s.sql_id = k.sql_id JOIN "
                 "(SELECT sid FROM sessions WHERE status <> 'ACTIVE') i ON k.sid = i.sid"),
])
def test_finished(spark, data, how, query):
    stats, snap, sessions = data
    assert _expanded(st.stats_of_finished(stats, snap, sessions, how)) == _sql(spark, data, query)


def test_not_in_an_empty_list_keeps_rows_without_session(spark, data):
    stats, snap, sessions = data
    none_active = sessions.where("status <> 'ACTIVE'")
    got = st.stats_of_finished(stats, snap, none_active, "not_in")
    assert _expanded(got) == _sql(spark, data, "SELECT s.* FROM stats s JOIN snap k ON s.sql_id = k.sql_id")


def test_other_sessions_without_a_cross_product(spark, data):
    stats, snap, sessions = data
    got = st.stats_other_sessions(stats, snap, sessions)
    assert _expanded(got) == _sql(
        spark, data, "SELECT s.* FROM stats s JOIN snap k ON s.sql_id = k.sql_id JOIN "
                     "(SELECT sid FROM sessions WHERE status = 'ACTIVE') a ON k.sid <> a.sid")
    plan = plan_of(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_semi_and_anti_make_the_whole(data):
    stats, snap, _ = data
    tracked = st.stats_of_tracked(stats, snap, "distinct")
    rest = stats.join(snap.select("sql_id"), "sql_id", "left_anti")
    assert tracked.count() + rest.count() == stats.count()
