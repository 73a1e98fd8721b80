"""Who runs how much: daily counts, concurrency, command mix, parallel workers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.shares import ratio

# The command code of SELECT, the assumed parallel degree of the tables.
SELECT_COMMAND = 3
PARALLEL_DEGREE = 24


def daily_counts(df: DataFrame, measure: str, day: str = "day", out: str = "executions") -> DataFrame:
    """The measure summed per day."""
    return df.groupBy(day).agg(F.sum(measure).alias(out))


def daily_summary(df: DataFrame, measure: str, since: date, day: str = "day") -> DataFrame:
    """Average, least and greatest daily sum after a day, one row."""
    totals = daily_counts(df.where(F.col(day) > F.lit(since)), measure, day, "n")
    return totals.agg(
        F.avg("n").alias("avg_per_day"), F.min("n").alias("min_per_day"), F.max("n").alias("max_per_day")
    )


def concurrency_histogram(snap: DataFrame, factor: int = PARALLEL_DEGREE) -> DataFrame:
    """Sessions per snapshot time, multiplied by the parallel degree, and how often each value occurs."""
    per_time = snap.groupBy("population_date").agg((F.count(F.lit(1)) * factor).alias("num_concur_sess"))
    return per_time.groupBy("num_concur_sess").agg(F.count(F.lit(1)).alias("frequency"))


def command_mix(executions: DataFrame, actions: DataFrame, target: int = SELECT_COMMAND) -> DataFrame:
    """Executions of one command against all others, with their shares of everything, one row.

    Commands without a known name are in the total only; executions without a statement id are
    nowhere. The log shrinks to one row per command before it meets the names.
    """
    counts = executions.groupBy("command").agg(F.count("sql_id").alias("cnt"))
    total = counts.agg(F.sum("cnt")).scalar()
    known = counts.join(actions.where(F.col("name").isNotNull()), F.col("command") == F.col("action")).withColumn(
        "total", total
    )
    chosen = F.sum(F.when(F.col("command") == target, F.col("cnt")))
    others = F.sum(F.when(F.col("command") != target, F.col("cnt")))
    return known.groupBy("total").agg(chosen.alias("cnt_sel"), others.alias("cnt_non_sel")).select(
        "cnt_sel", ratio(F.col("cnt_sel"), F.col("total")).alias("share_sel"),
        "cnt_non_sel", ratio(F.col("cnt_non_sel"), F.col("total")).alias("share_non_sel"),
        "total",
    )


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """Rows per value of a column, NULL included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))


def drill_down(df: DataFrame, column: str, value) -> DataFrame:
    """The rows behind one value."""
    return df.where(F.col(column) == F.lit(value))


def parallel_workers(sessions: DataFrame, sql_area: DataFrame, processes: DataFrame, px_sessions: DataFrame,
                     sql_keys: list[str], process_keys: list[str], active: Column | None = None,
                     text_width: int | None = None) -> DataFrame:
    """Active sessions that work for a parallel query, with coordinator, statement and process.

    ``text_width`` cuts the statement text for display; None shows it whole. The narrow worker list comes
    first, so the statement texts meet only the sessions that remain.
    """
    shown = F.col("sql_text") if text_width is None else F.substring("sql_text", 1, text_width)
    test = active if active is not None else F.col("status") == "ACTIVE"
    return (
        sessions.where(test)
        .join(px_sessions, "sid")
        .join(processes, process_keys)
        .join(sql_area, sql_keys)
        .withColumn("sql_text", shown)
        .orderBy("qcsid", "sid")
    )
