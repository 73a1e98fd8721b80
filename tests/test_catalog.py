from datetime import date, datetime

import pytest

from opsight.operators import catalog as cat, freshness, interfaces as inter, workload as wl
from opsight.session import scratch_path
from opsight.sources import writers
from tests.conftest import rows_of

NOW = datetime(2024, 3, 10, 8)


def test_freshness(make):
    control = make("procedure_name string, run_date timestamp_ntz",
                   [("RUN", "2024-03-09T23:59:59"), ("RATE", "2024-03-08T00:00:00"), ("X", None)])
    row = freshness.log_freshness(control, NOW, "RUN", "RATE").first()
    assert (row["other_facts_days_diff"], row["cdrs_days_diff"]) == (1, 3)
    assert freshness.log_freshness(control, NOW, "RUN", "RATE", 0).first()["cdrs_days_diff"] == 2
    assert freshness.log_freshness(control, NOW, "GONE", "RATE").first()["dw_last_run"] is None
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        freshness.log_freshness(control.union(control), NOW, "RUN", "RATE").collect()


def test_the_freshness_table_is_created_once(spark, make):
    control = make("procedure_name string, run_date timestamp_ntz", [("RUN", "2024-03-09T00:00:00")])
    path = scratch_path(spark, "once")
    assert freshness.create_freshness_table(control, NOW, "RUN", "RATE", path).count() == 1
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        freshness.create_freshness_table(control, NOW, "RUN", "RATE", path)
    writers.append(freshness.log_freshness(control, NOW, "RUN", "RATE"), path)
    assert spark.read.parquet(path).count() == 2


def test_versions_appear_only_when_complete(spark):
    path = scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        writers.read_version(spark, path)
    writers.write_version(spark.range(5), path)
    first = writers.read_version(spark, path)
    assert writers.write_version(first.where("id > 1"), path) == 2
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=3")
    assert writers.read_version(spark, path).count() == 3
    assert writers.read_version(spark, path, 1).count() == 5


def test_interfaces(make):
    control = make("table_name string, data_ref_date timestamp_ntz",
                   [("A", "2024-03-08T23:59:59"), ("b", "2024-03-09T00:00:00"), ("C", "2024-03-01T00:00:00"), ("D", None)])
    assert rows_of(inter.stale_interfaces(control, date(2024, 3, 10)), "table_name") == [("A",), ("C",)]
    interfaces = make("flow_name string, table_name string, start_date_key timestamp_ntz",
                      [("F", "A", "2024-03-01T00:00:00"), ("F", "B", "2024-03-01T00:00:00"),
                       ("F", "C", "2024-03-09T00:00:00"), ("G", "D", "2024-03-01T00:00:00"),
                       ("F", "A", "2024-03-01T00:00:00")])
    runs = make("procedure_name string, run_date timestamp_ntz", [("RUN", "2024-03-05T00:00:00")])
    assert rows_of(inter.flow_interfaces(control, interfaces, runs, "F", "RUN"), "table_name") == [("A",)]
    upper = inter.flow_interfaces(control, interfaces, runs, "F", "RUN", upper=True)
    assert [r["table_name"] for r in upper.collect()] == ["A", "b"]
    assert inter.flow_interfaces(control, interfaces, runs.where("1 = 0"), "F", "RUN").count() == 0
    log = control.union(control)
    assert inter.load_log(log, ["A", "D"]).count() == 4
    assert [r["cnt"] for r in inter.loads_per_ref_date(log).collect()] == [2, 2, 2, 2]
    assert inter.loads_per_ref_date(log).first()["data_ref_date"] is None
    assert inter.loads_on(log, date(2024, 3, 9)).first()["cnt"] == 2


def test_space_usage(make):
    spaces = make("tablespace_name string, contents string, extent_management string, status string", [
        ("A", "PERMANENT", "LOCAL", "ONLINE"), ("NOFILES", "PERMANENT", "LOCAL", "ONLINE"),
        ("NOFREE", "PERMANENT", "LOCAL", "ONLINE"), ("T", "TEMPORARY", "LOCAL", "ONLINE"),
        ("TD", "TEMPORARY", "DICTIONARY", "ONLINE"), ("TEMPTY", "TEMPORARY", "LOCAL", "ONLINE"),
        ("UNKNOWN", None, "LOCAL", "ONLINE"),
    ])
    mb = 1024 * 1024
    size = "tablespace_name string, bytes long"
    files = make(size, [("A", 6 * mb), ("A", 2 * mb), ("NOFREE", 4 * mb), ("TD", 3 * mb), ("T", mb)])
    free = make(size, [("A", 2 * mb), ("NOFILES", mb)])
    temp = make(size, [("T", 8 * mb)])
    used = make("tablespace_name string, bytes_used long", [("T", mb), ("T", mb)])
    got = cat.space_usage(spaces, files, free, temp, used)
    assert rows_of(got, "tablespace_name", "avail_mbs", "used_mbs", "free_mbs", "used_pct") == [
        ("A", 8.0, 6.0, 2.0, 75.0), ("NOFILES", 0.0, 0.0, 1.0, 0.0), ("NOFREE", 4.0, 4.0, 0.0, 100.0),
        ("T", 8.0, 2.0, 6.0, 25.0), ("TD", 3.0, 3.0, 0.0, 100.0), ("TEMPTY", 0.0, 0.0, 0.0, 0.0),
    ]
    tables = make("owner string, table_name string, tablespace_name string",
                  [("X", "1", "A"), ("Y", "2", "A"), ("Y", "3", "T"), (None, "4", "NOFREE")])
    # the shared space counts on both sides
    assert cat.space_by_area(got, tables, ["X"]).first()[0] == 8.0
    assert cat.space_by_area(got, tables, ["X"], negate=True).first()[0] == 16.0
    assert rows_of(cat.spaces_of_owners(tables, ["X", "Y"])) == [("A",), ("T",)]
    segments = make("segment_name string, bytes long", [("M1", mb), ("M1", mb), ("Z", mb)])
    assert cat.summary_size(segments, make("container_name string", [("M1",), ("M1",)])).first()[0] == 2.0


def test_missing_comments(make):
    comments = make("owner string, column_name string, comments string", [
        ("A", "1", None), ("A", "2", None), ("A", "3", "text"), ("B", "1", None), ("C", "1", None), ("D", "1", "text"),
    ])
    scope = make("schema_name string, include_ind int", [("A", 1), ("B", 1), ("C", 0), ("D", 1), ("A", 1)])
    assert rows_of(cat.missing_comment_share(comments, scope)) == [("A", 66.7), ("B", 33.3)]


def test_user_lookups(spark, make):
    users = make("user_id long, username string, created timestamp_ntz, profile string", [
        (1, "TARGET_A", "2013-01-12T23:00:00", "DEFAULT"), (2, "B", "2013-01-13T00:00:00", "ANALYST"),
        (3, "C", "2013-01-13T00:00:00", None),
    ])
    got = cat.user_segment(users, date(2013, 1, 12), "ANALYST", view="segment")
    assert rows_of(got, "user_id") == [(1,), (2,)] and spark.table("segment").count() == 2
    assert rows_of(cat.pattern_lookup(users, "username", "TARGET%"), "user_id") == [(1,)]
    assert rows_of(cat.exact_lookup(users, "username", "B"), "user_id") == [(2,)]


def test_workload(make):
    days = make("day date, n long", [(date(2024, 1, 1), 5), (date(2024, 1, 2), 1), (date(2024, 1, 2), 2), (date(2024, 1, 3), 9)])
    assert tuple(wl.daily_summary(days, "n", date(2024, 1, 1)).first()) == (6.0, 3, 9)
    runs = make("sql_id string, command int, program string", [
        ("a", 3, "x"), ("b", 3, "y"), ("c", 2, "x"), ("d", 99, "x"), (None, 3, "x"), ("e", None, "x"),
    ])
    actions = make("action int, name string", [(3, "SELECT"), (2, "INSERT"), (99, None)])
    assert tuple(wl.command_mix(runs, actions).first()) == (2, 0.4, 1, 0.2, 5)
    assert wl.command_mix(runs, actions.where("name = 'NONE'")).count() == 0
    snap = make("population_date timestamp_ntz", [("2024-01-01T00:00:00",)] * 3 + [("2024-01-02T00:00:00",)] * 3
                + [("2024-01-03T00:00:00",)])
    assert rows_of(wl.concurrency_histogram(snap)) == [(24, 1), (72, 2)]
    assert rows_of(wl.value_frequency(runs.fillna({"command": 0}), "command")) == [(0, 1), (2, 1), (3, 3), (99, 1)]
    assert wl.drill_down(runs, "command", 99).count() == 1


def test_parallel_workers(make):
    sessions = make("sid long, status string, sql_id string", [(1, "ACTIVE", "a"), (2, "INACTIVE", "a"), (3, "ACTIVE", "b")])
    area = make("sql_id string, sql_text string", [("a", "x" * 150)])
    tables = [sessions, area, make("sid long, spid long", [(1, 11), (2, 12)]),
              make("sid long, qcsid long", [(1, 9), (2, 9), (3, 9)]), ["sql_id"], ["sid"]]
    for width, shown in ((100, 100), (None, 150)):
        got = wl.parallel_workers(*tables, text_width=width).collect()
        assert [(r["sid"], r["qcsid"], r["spid"], len(r["sql_text"])) for r in got] == [(1, 9, 11, shown)]
