"""Source interfaces: which data has arrived."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from opsight.functions.times import moment


def stale_interfaces(load_control: DataFrame, today: date) -> DataFrame:
    """Interfaces whose data is older than yesterday."""
    yesterday = datetime.combine(today - timedelta(days=1), datetime.min.time())
    return load_control.where(F.col("data_ref_date") < moment(yesterday))


def flow_interfaces(load_control: DataFrame, interfaces: DataFrame, control: DataFrame, flow: str, procedure: str,
                    upper: bool = False) -> DataFrame:
    """The interfaces of a flow that were due at its last run, oldest data first.

    ``upper`` compares both names in upper case.
    """

    def key(name):
        return F.upper(name) if upper else F.col(name)

    last_run = control.where(F.col("procedure_name") == procedure).select("run_date").scalar()
    due = interfaces.where((F.col("flow_name") == flow) & (F.col("start_date_key") <= last_run)).select(
        key("table_name").alias("_key")
    )
    return (
        load_control.join(due, key("table_name") == F.col("_key"), "left_semi")
        .orderBy(F.col("data_ref_date").asc_nulls_last())
    )


def load_log(log: DataFrame, tables: list[str]) -> DataFrame:
    """Load history of the named tables."""
    return log.where(F.col("table_name").isin(*tables))


def loads_per_ref_date(log: DataFrame) -> DataFrame:
    """Loads per data date, newest first."""
    return log.groupBy("data_ref_date").agg(F.count(F.lit(1)).alias("cnt")).orderBy(
        F.col("data_ref_date").desc_nulls_first()
    )


def loads_on(log: DataFrame, ref_date: date) -> DataFrame:
    """Number of loads of one data date, one row."""
    at = moment(datetime.combine(ref_date, datetime.min.time()))
    return log.where(F.col("data_ref_date") == at).agg(F.count(F.lit(1)).alias("cnt"))
