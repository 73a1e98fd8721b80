from pyspark.sql import functions as F
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from opsight.operators import phases, sla
from tests.conftest import plan_of, rows_of

SPEC = [sla.Milestone("MAIN", "RUN_DATE", "%MAIN"), sla.Milestone("SUB", "SUB_DATE", "%SUB_MAIN")]


def test_finish_within_the_cutoff_hour_passes_in_legacy_mode(runs):
    ends = ["08:59:59", "09:00:00", "09:59:59", "10:00:00"]
    df = runs([(i, None, i, "X_MAIN", "2024-03-01T01:00:00", f"2024-03-01T{e}") for i, e in enumerate(ends)])
    legacy = sla.sla_hit_rate(df, SPEC, "MAIN", "09:00", 5, now=datetime(2024, 3, 2)).first()
    assert tuple(legacy) == (3, 4, 75)
    minute = sla.sla_hit_rate(df, SPEC, "MAIN", "09:00", 5, now=datetime(2024, 3, 2), mode="minute").first()
    assert tuple(minute) == (2, 4, 50)


def test_no_runs_give_one_row_of_nulls(runs):
    out = sla.sla_hit_rate(runs([]), SPEC, "MAIN", "09:00", 5, from_date=datetime(2024, 3, 2)).collect()
    assert [tuple(r) for r in out] == [(None, None, None)]


def test_hit_rate_does_not_rank(runs):
    plan = plan_of(sla.sla_hit_rate(runs([]), SPEC, "MAIN", "09:00", 5, now=datetime(2024, 3, 2)))
    assert "Window" not in plan and "Join" not in plan


def test_window_ends_are_included_and_a_run_may_match_twice(runs):
    df = runs([
        (1, None, 1, "A_SUB_MAIN", "2024-03-01T00:00:00", "2024-03-01T02:00:00"),
        (2, None, 2, "B_MAIN", "2024-03-11T00:00:00", "2024-03-11T02:00:00"),
        (3, None, 3, "B_MAIN", "2024-03-11T00:00:01", "2024-03-11T02:00:00"),
        (4, None, 4, "B_MAIN", "2024-02-29T23:59:59", "2024-03-01T02:00:00"),
    ])
    got = sla.flow_milestones(df, SPEC, 9, from_date=datetime(2024, 3, 10))
    assert rows_of(got, "execution_name", "flow", "r") == [
        ("A_SUB_MAIN", "MAIN", 1), ("A_SUB_MAIN", "SUB", 1), ("B_MAIN", "MAIN", 1),
    ]


def test_rank_agrees_with_sql_rank(spark, runs):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        start = datetime(2024, 3, 1) + timedelta(minutes=rng.randrange(3 * 1440))
        rows.append((i, None, i, "F_MAIN", start.isoformat(), (start + timedelta(minutes=rng.randrange(400))).isoformat()))
    df = runs(rows)
    got = sla.flow_milestones(df, SPEC[:1], 10, now=datetime(2024, 3, 5))
    got.createOrReplaceTempView("ranked")
    wrong = spark.sql("""SELECT count(*) FROM (SELECT r, rank() OVER (PARTITION BY execution_date
                         ORDER BY end_execution DESC) AS want FROM ranked) WHERE r <> want""").first()[0]
    assert wrong == 0 and got.count() == 300


def test_late_runs_spare_the_weekend(runs):
    df = runs([
        (1, None, 1, "F", "2024-03-01T01:00:00", "2024-03-01T12:00:00"),  # Friday
        (2, None, 2, "F", "2024-03-02T01:00:00", "2024-03-02T12:00:00"),
        (3, None, 3, "F", "2024-03-03T01:00:00", "2024-03-03T12:00:00"),
        (4, None, 4, "F", "2024-03-04T01:00:00", "2024-03-04T11:00:00"),  # exactly at the hour
        (5, None, 5, "F", "2024-04-01T01:00:00", "2024-04-01T10:00:00"),
    ])
    assert rows_of(sla.monthly_late_runs(df)) == [("2024/03", 1), ("2024/04", 0)]
    assert rows_of(sla.monthly_late_runs(df, weekend_exempt=False)) == [("2024/03", 3), ("2024/04", 0)]


def _brute(first, second):
    out = Counter()
    for _, _, _, name, s1, e1 in first:
        for *_, s2, e2 in second:
            if e1[:16] == e2[:16]:
                seconds = (datetime.fromisoformat(s2) - datetime.fromisoformat(s1)).total_seconds()
                out[(name, int(seconds / 3600))] += 1
    return sorted((n, d, c) for (n, d), c in out.items())


@pytest.mark.parametrize("seed", range(4))
def test_counted_pairs_equal_built_pairs(runs, seed):
    rng = random.Random(seed)

    def some(n, names, base):
        out = []
        for i in range(n):
            end = datetime(2024, 3, 2, 5, rng.randrange(3), rng.randrange(60))
            # many starts on whole hours apart, so that equal offsets occur
            start = end.replace(minute=0, second=rng.choice([0, 0, 7])) - timedelta(
                hours=rng.randrange(6), minutes=rng.choice([0, 0, 30]))
            out.append((base + i, None, base + i, rng.choice(names), start.isoformat(), end.isoformat()))
        return out

    first, second = some(40, ["A", "B"], 0), some(50, ["C"], 1000)
    got = phases.phase_between(runs(first), runs(second))
    assert rows_of(got, "execution_name", "duration", "frequency") == _brute(first, second)


def test_counted_pairs_know_fractions_of_a_second(runs):
    first = [(1, None, 1, "A", "2024-03-01T02:00:00.500000", "2024-03-01T05:00:10")]
    second = [(2, None, 2, "B", "2024-03-01T03:00:00.400000", "2024-03-01T05:00:59"),
              (3, None, 3, "B", "2024-03-01T03:00:00.500000", "2024-03-01T05:00:00"),
              (4, None, 4, "B", "2024-03-01T01:00:00.400000", "2024-03-01T05:00:00"),
              (5, None, 5, "B", "2024-03-01T01:00:00.600000", "2024-03-01T05:00:00"),
              (6, None, 6, "B", "2024-03-01T03:00:00.500000", "2024-03-01T05:01:00")]
    got = phases.phase_between(runs(first), runs(second))
    assert rows_of(got, "duration", "frequency") == [(-1, 1), (0, 2), (1, 1)]


def test_phase_to_root_and_offset(runs):
    df = runs([
        (1, None, 1, "F", "2024-03-01T01:00:00", "2024-03-01T09:00:00"),
        (2, 1, 1, "F:S", "2024-03-01T03:30:00", "2024-03-01T04:00:00"),
        (3, 9, 9, "G:S", "2024-03-01T03:30:00", "2024-03-01T04:00:00"),
    ])
    steps = df.where("execution_name LIKE '%:S'")
    assert rows_of(phases.phase_to_root_end(steps, df), "execution_audit_id", "duration") == [(2, 5)]
    offset = phases.step_offset_from_root(steps, df.where("execution_name = 'F'"))
    assert rows_of(offset, "execution_audit_id", "duration", "tot_cnt") == [(2, 2, 1)]


def test_trimmed_mean(make):
    hist = make("execution_name string, duration long, frequency long", [
        ("A", 2, 4), ("A", 4, 2), ("A", 6, 1), ("A", 0, 9), ("A", 11, 9), ("A", 25, 5), ("A", 30, 5), ("B", 8, 2),
    ])
    assert phases.trimmed_weighted_mean(hist).first()[0] == pytest.approx((8 + 8 + 16) / 8)
    assert phases.trimmed_weighted_mean(hist, low=-1).first()[0] == pytest.approx(32 / 17, abs=1e-6)
    assert phases.trimmed_weighted_mean(hist.where("1 = 0")).first()[0] is None


def test_latest_rank_keeps_rows_without_a_value(make):
    from opsight.functions.running import latest_rank

    df = make("day string, finish timestamp_ntz, id int", [
        ("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 11:00:00", 2), (None, None, 3), (None, None, 4),
    ])
    got = latest_rank(df, ["day"], "finish", F.hour("finish"), "r")
    assert sorted((r["id"], r["r"]) for r in got.collect()) == [(1, 2), (2, 1), (3, 1), (4, 1)]
