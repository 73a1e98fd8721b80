"""How old the loaded data is."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsight.functions.times import moment
from opsight.sources.writers import create_once


def log_freshness(control: DataFrame, now: datetime, last_run: str, rate: str, rate_correction: int = 1) -> DataFrame:
    """One log row: the two run dates and their age in days.

    The rate date names the next day to load, so ``rate_correction`` takes one day off before its age
    is taken. A procedure found twice is an error; one not found gives NULL.
    """

    def run_date(procedure: str):
        return control.where(F.col("procedure_name") == procedure).select("run_date").scalar()

    today = F.to_date(F.lit(now.date().isoformat()))
    row = control.sparkSession.range(1).select(
        moment(now).alias("snapshot_datetime"), run_date(last_run).alias("dw_last_run"),
        run_date(rate).alias("rate_date"),
    )
    return row.select(
        "*",
        F.datediff(today, F.col("dw_last_run").cast("date")).alias("other_facts_days_diff"),
        F.datediff(today, F.date_sub(F.col("rate_date").cast("date"), rate_correction)).alias("cdrs_days_diff"),
    )


def create_freshness_table(control: DataFrame, now: datetime, last_run: str, rate: str, path: str) -> DataFrame:
    """Create the log from its first row, without the correction; an existing log is an error."""
    create_once(log_freshness(control, now, last_run, rate, rate_correction=0), path)
    return control.sparkSession.read.parquet(path)
