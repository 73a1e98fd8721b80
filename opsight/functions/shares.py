"""Shares of a total, taken over grouped rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ratio(part: Column, total: Column) -> Column:
    return part.cast("double") / total.cast("double")


def with_share(grouped: DataFrame, count: str, share: str, digits: int | None = None, factor: float = 1.0) -> DataFrame:
    """Add ``count / sum(count)``, rounded only if ``digits`` are given.

    The total is a scalar subquery over the grouped rows. Its plan is the same up to the exchange,
    so Spark runs the scan and the shuffle once, and no window brings all rows to one task.
    """
    total = grouped.agg(F.sum(count)).scalar()
    value = ratio(F.col(count), total) * F.lit(float(factor))
    return grouped.withColumn(share, F.round(value, digits) if digits is not None else value)


def with_share_within(grouped: DataFrame, keys: list[str], count: str, share: str, digits: int | None = None) -> DataFrame:
    """Add each row's share of its key's total; both sides are grouped rows."""
    totals = grouped.groupBy(*keys).agg(F.sum(count).alias("_total"))
    value = ratio(F.col(count), F.col("_total"))
    return (
        grouped.join(totals, keys)
        .withColumn(share, F.round(value, digits) if digits is not None else value)
        .drop("_total")
    )
