from datetime import date

import pytest

from opsight.operators import workload as wl
from opsight.session import scratch_path
from opsight.sources import derived, readers, schemas, snapshots
from tests.conftest import plan_of, rows_of

FOLDER = "/root/testdata/sf0.001"


def test_dated_reads_open_only_their_days(spark):
    path = scratch_path(spark, "snapshot")
    snap = derived.logical(spark, FOLDER, derived.session_snap)
    snapshots.append_snapshot(snap, path)
    some = snapshots.read_snapshot(spark, path, date(2024, 1, 5), date(2024, 1, 6))
    plan = plan_of(wl.concurrency_histogram(some))
    assert "PartitionFilters: [isnotnull(population_day" in plan and "(population_day" in plan
    want = snap.where("population_date >= '2024-01-05' AND population_date < '2024-01-07'")
    assert some.count() == want.count() > 0
    assert snapshots.read_snapshot(spark, path).count() == snap.count()


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "json"])
def test_files_of_each_format(spark, make, fmt):
    path = scratch_path(spark, fmt)
    df = make("a long, b string", [(1, "x"), (2, None)])
    df.write.format(fmt).save(path)
    assert rows_of(readers.read_files(spark, path, fmt, schema=df.schema).fillna({"b": "-"})) == [(1, "x"), (2, "-")]
    if fmt in ("csv", "json"):
        with pytest.raises(ValueError):
            readers.read_files(spark, path, fmt)


def test_tables_by_name(spark, make):
    make("a long", [(1,)]).createOrReplaceTempView("some_table")
    assert readers.read_table(spark, "some_table").count() == 1


@pytest.mark.parametrize("schema,table", [
    (schemas.EXECUTIONS, derived.executions), (schemas.FLOW_DIM, derived.flow_dim),
    (schemas.FLOW_STEPS, derived.flow_steps), (schemas.HIERARCHY, derived.hierarchy),
    (schemas.SESSION_SNAP, derived.session_snap), (schemas.SQLSTATS_SNAP, derived.sqlstats), (schemas.USERS, derived.users),
    (schemas.SQL_EXECUTIONS, derived.sql_exec), (schemas.ACTIONS, derived.actions), (schemas.USER_DAY, derived.user_day),
    (schemas.CONTROL, derived.control), (schemas.LOAD_CONTROL, derived.load_control), (schemas.LOAD_LOG, derived.load_log),
    (schemas.INTERFACE_TABLES, derived.interface_tables), (schemas.COLUMN_COMMENTS, derived.comments),
    (schemas.SCHEMA_SCOPE, derived.schema_scope), (schemas.STORAGE_SPACES, derived.spaces),
    (schemas.SPACE_BYTES, derived.data_files), (schemas.OWNED_TABLES, derived.owned_tables),
    (schemas.MVIEW_LINKS, derived.mview_links),
])
def test_logical_tables_fit_their_schema(spark, schema, table):
    df = derived.logical(spark, FOLDER, table)
    out = schemas.conform(df, schema)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in schema.fields]
    assert set(df.columns) == set(schema.fieldNames())
    assert out.count() > 0


def test_marks_prune_the_days(spark, make):
    from datetime import datetime

    from opsight.operators import capture as cap
    from tests.conftest import plan_of, rows_of

    def rows(*some):
        return make("fixed_table_sequence long, population_date timestamp_ntz, instance_startup_date timestamp_ntz",
                    [(n, None if day is None else f"2024-01-{day:02d}T05:00:00", f"2023-12-{i:02d}T00:00:00") for n, day, i in some])

    batches = [[(5, 1, 1), (9, 2, 1), (3, 2, 2)], [(7, 3, 2), (8, 3, 2), (99, None, 2)], [(1, 5, 3), (50, 4, 1), (2, 6, 3)]]
    path = scratch_path(spark, "marked")
    for b in batches:
        snapshots.append_snapshot(rows(*b), path, instance="instance_startup_date")
    whole, source = rows(*sum(batches, [])), rows(*[(n, 9, 1) for n in range(60)])
    for i, days in ((1, {4, 5, 6}), (2, {3, 4, 5, 6}), (3, {6}), (4, {6})):
        epoch = datetime(2023, 12, i)
        part = snapshots.read_newest(spark, path, epoch)
        assert {r.population_date.day for r in part.collect()} == days
        assert "PartitionFilters: [isnotnull(population_day" in plan_of(part)
        assert rows_of(cap.changed_since_hwm(source, part, epoch)) == rows_of(cap.changed_since_hwm(source, whole, epoch))
    # an instance without a dated row: all is read
    undated = scratch_path(spark, "undated")
    snapshots.append_snapshot(rows((4, None, 5), (6, 1, 1), (7, 2, 6)), undated, instance="instance_startup_date")
    assert snapshots.read_newest(spark, undated, datetime(2023, 12, 5)).count() == 3
