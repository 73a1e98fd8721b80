"""Deadlines: milestones of the flows, hit rates and late runs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.matching import any_of
from opsight.functions.running import latest_rank
from opsight.functions.times import day_of, moment, month_text, plus_seconds, start_of_day


@dataclass(frozen=True)
class Milestone:
    """A flow, the control date it belongs to and the name pattern of the step that ends it."""

    flow: str
    related_date: str
    pattern: str


def _matching(df: DataFrame, spec: list[Milestone], from_date: datetime | None, now: datetime | None,
              days_back: int) -> DataFrame:
    """One row per (run, matching milestone).

    The milestones are a short literal list, so each row tests them itself: one scan, no join.
    """
    origin = from_date if from_date is not None else now
    if origin is None:
        raise ValueError("give from_date or now")
    name = F.col("execution_name")
    hits = F.array_compact(F.array(*[
        F.when(name.like(m.pattern), F.struct(F.lit(m.flow).alias("flow"), F.lit(m.related_date).alias("related_date")))
        for m in spec
    ]))
    window = F.col("created_on").between(moment(origin - timedelta(days=days_back)), moment(origin + timedelta(days=1)))
    return (
        df.where(window & any_of([name.like(m.pattern) for m in spec]))
        .select("execution_name", "created_on", "updated_on", F.explode(hits).alias("hit"))
        .select(
            "hit.flow", "hit.related_date", day_of("updated_on").alias("execution_date"), "execution_name",
            F.col("created_on").alias("start_execution"), F.col("updated_on").alias("end_execution"),
        )
    )


def flow_milestones(df: DataFrame, spec: list[Milestone], days_back: int, from_date: datetime | None = None,
                    now: datetime | None = None, flow: str | None = None) -> DataFrame:
    """Matching runs with their day and their rank within it, latest finish first.

    The start must lie in ``[from_date - days_back, from_date + 1 day]``, both ends included.
    """
    rows = _matching(df, [m for m in spec if flow is None or m.flow == flow], from_date, now, days_back)
    return latest_rank(rows, ["execution_date"], "end_execution", F.hour("end_execution"), "r")


def sla_hit_rate(df: DataFrame, spec: list[Milestone], flow: str, cutoff: str, days_back: int,
                 from_date: datetime | None = None, now: datetime | None = None,
                 mode: str = "legacy_hour") -> DataFrame:
    """How many runs of a flow finished by the cutoff (``HH:mm``), one row.

    ``legacy_hour`` compares the two-digit finish hour as text with the whole cutoff, so every
    finish within the cutoff's hour passes; ``minute`` compares hours and minutes.
    """
    mask = {"legacy_hour": "HH", "minute": "HH:mm"}[mode]
    rows = _matching(df, [m for m in spec if m.flow == flow], from_date, now, days_back)
    hit = F.when(F.date_format("end_execution", mask) <= F.lit(cutoff), 1).otherwise(0)
    return rows.agg(F.sum(hit).alias("times_success"), F.sum(F.lit(1)).alias("times_all")).select(
        "times_success", "times_all",
        F.round(F.col("times_success") / F.when(F.col("times_all") != 0, F.col("times_all")) * 100)
        .cast("bigint").alias("pcnt_success"),
    )


def late_flag(finish: Column, hour: int, weekend_exempt: bool) -> Column:
    late = F.when(finish > plus_seconds(start_of_day(finish), hour * 3600), 1).otherwise(0)
    if not weekend_exempt:
        return late
    return F.when(F.dayofweek(day_of(finish)).isin(1, 7), 0).otherwise(late)


def monthly_late_runs(df: DataFrame, hour: int = 11, weekend_exempt: bool = True) -> DataFrame:
    """Per finish month the number of runs that finished after the hour of their finish day.

    With ``weekend_exempt``, Saturday and Sunday finishes count as on time.
    """
    return df.groupBy(month_text("updated_on").alias("month")).agg(
        F.sum(late_flag(F.col("updated_on"), hour, weekend_exempt)).alias("orders_delay_cnt")
    )
