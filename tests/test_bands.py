from datetime import datetime

import pytest

from opsight.functions import banding
from opsight.operators import bands, executions as ex
from tests.conftest import plan_of, rows_of

MIDNIGHT = "2024-03-01T00:00:00"


def test_legacy_elapsed_bands_have_gaps(make):
    values = [4.99, 5.0, 5.5, 6.0, 10.0, 10.01, 30.0, 30.5, 31.0, 60.5, 120.0, 121.0, None]
    df = make("v double", [(v,) for v in values])
    got = [r["elpsd_time_band"] for r in bands.tag_elapsed_band(df, "v", banding.ELAPSED_LEGACY).collect()]
    assert got == [
        "lt_5", "gt_120", "gt_120", "between_06-10", "between_06-10", "between_10-30", "between_10-30", "gt_120",
        "between_31-60", "gt_120", "between_61-120", "gt_120", "gt_120",
    ]


def test_contiguous_bands_have_none(make):
    df = make("v double", [(4.99,), (5.0,), (30.5,), (121.0,), (None,)])
    spec = banding.contiguous([5, 10, 30, 60, 120])
    got = [r["elpsd_time_band"] for r in bands.tag_elapsed_band(df, "v", spec).collect()]
    assert got == ["lt_5", "5_to_10", "30_to_60", "ge_120", "unknown"]


def test_durations_are_cut_toward_zero(runs):
    df = runs([
        (1, None, 1, "F", MIDNIGHT, "2024-03-01T01:00:00"),
        (2, None, 2, "F", MIDNIGHT, "2024-03-01T00:59:59"),
        (3, None, 3, "F", MIDNIGHT, MIDNIGHT),
        (4, None, 4, "F", MIDNIGHT, "2024-02-29T22:30:00"),
        (5, None, 5, "F", MIDNIGHT, None),
        (6, None, 6, "F", MIDNIGHT, "2024-03-01T11:00:00"),
        (7, None, 7, "F", MIDNIGHT, "2024-03-01T10:59:59"),
    ])
    got = {r["duration_time_band"]: r["frequency"] for r in bands.duration_histogram(df).collect()}
    assert got == {"1": 1, "0": 2, "-1": 1, None: 1, "gt_10": 1, "10": 1}


def test_minute_bands_keep_the_otherwise_rule(runs):
    df = runs([
        (1, None, 1, "F", MIDNIGHT, None),
        (2, None, 2, "F", MIDNIGHT, "2024-02-29T23:00:00"),
        (3, None, 3, "F", MIDNIGHT, "2024-03-01T00:00:59"),
        (4, None, 4, "F", MIDNIGHT, "2024-03-01T04:01:00"),
    ])
    long = {r["duration_time_band"]: r["frequency"] for r in bands.duration_bands(df, banding.MINUTES_LONG).collect()}
    assert long == {"lt_60": 2, "0": 1, "gt_240": 1}
    short = {r["duration_time_band"]: r["frequency"] for r in bands.duration_bands(df, banding.MINUTES_SHORT).collect()}
    assert short == {None: 1, "lt_10": 2, "gt_30": 1}


def test_shares_are_of_all_rows_and_frequencies_add_up(runs):
    df = runs([(i, None, i, f"F{i % 3}", MIDNIGHT, f"2024-03-01T0{i % 5}:00:00") for i in range(1, 31)])
    got = bands.duration_histogram(df).collect()
    assert sum(r["frequency"] for r in got) == 30
    assert sum(r["prcnt"] for r in got) == pytest.approx(1.0, abs=1e-4)


def test_a_run_at_the_change_is_on_neither_side(runs):
    df = runs([
        (1, None, 1, "F", "2024-03-01T00:00:00", "2024-03-01T00:05:00"),
        (2, None, 2, "F", "2024-03-02T00:00:00", "2024-03-02T00:05:00"),
        (3, None, 3, "F", "2024-03-03T00:00:00", "2024-03-03T00:25:00"),
        (4, None, 4, "F", "2024-03-03T00:00:00", "2024-03-03T00:05:00"),
    ])
    got = bands.before_after_bands(df, datetime(2024, 3, 2))
    assert rows_of(got, "side", "duration_time_band", "frequency", "prcnt") == [
        ("after", "between_21-30", 1, 0.5), ("after", "lt_10", 1, 0.5), ("before", "lt_10", 1, 1.0),
    ]


def test_plain_histogram_can_be_kept(runs):
    df = runs([(1, None, 1, "F", MIDNIGHT, "2024-03-01T05:30:00"), (2, None, 2, "G", MIDNIGHT, "2024-03-01T05:00:00")])
    assert rows_of(bands.rebanded_histogram(df, None)) == [("F", 5, 1), ("G", 5, 1)]
    assert rows_of(bands.rebanded_histogram(df)) == [("between_05-10", 2)]


def test_share_reads_the_table_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    out = bands.elapsed_band_share(df, "value")
    out.collect()
    plan = plan_of(out)
    final = plan.split("Initial Plan")[0]
    assert "ReusedExchange" in plan
    assert "Window" not in final and "CartesianProduct" not in plan


def test_normalize_needs_the_key_columns(make):
    df = make("AUDIT_EXECUTION_ID long, TASK_NAME string, CREATION_DATE timestamp_ntz, LAST_UPDATE_DATE timestamp_ntz, "
              "ELAPSE long", [(1, "F", MIDNIGHT, MIDNIGHT, 7)])
    out = ex.normalize_executions(df, "base")
    assert out.columns == ["execution_audit_id", "execution_name", "created_on", "updated_on", "elapse"]
    with pytest.raises(ValueError):
        ex.normalize_executions(df, "view")


def test_successful_bounds_are_strict(runs):
    df = runs([
        (1, None, 1, "F", MIDNIGHT, MIDNIGHT),
        (2, None, 2, "F", "2024-03-01T00:00:01", MIDNIGHT),
        (3, 2, 2, "F:S", "2024-03-01T00:00:01", MIDNIGHT),
        (4, None, 4, "G", "2024-03-01T00:00:01", MIDNIGHT),
        (5, None, 5, "F", "2024-03-01T00:00:01", MIDNIGHT, "FAILED"),
    ])
    got = ex.successful(df, ["F"], ["F:%"], since=datetime(2024, 3, 1))
    assert rows_of(got, "execution_audit_id") == [(2,), (3,)]
    assert rows_of(ex.successful(df, roots_only=True), "execution_audit_id") == [(1,), (2,), (4,)]
    assert [r[0] for r in ex.latest_runs(df, ["F%"], 2).select("execution_audit_id").collect()] == [5, 3]


def test_like_underscore_is_one_character(runs):
    df = runs([(1, None, 1, "S_1", MIDNIGHT, MIDNIGHT), (2, None, 2, "SX1", MIDNIGHT, MIDNIGHT),
               (3, None, 3, "SXX1", MIDNIGHT, MIDNIGHT)])
    assert rows_of(ex.named(df, like=["S_1"]), "execution_audit_id") == [(1,), (2,)]


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = plan_of(ex.named(df.withColumnRenamed("o_orderstatus", "execution_name"), names=["F", "O"]).select("o_orderkey"))
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan
