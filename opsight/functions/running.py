"""Running totals and ranks that survive a hot key.

A window over a key that holds a third of all rows sorts them in one task. Here the key is split in
order-preserving buckets: bucket totals give each bucket its start value, and a second window runs
inside (key, bucket) only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, WindowSpec, functions as F


def running_total(
    df: DataFrame, keys: list[str], order: str, bucket: Column, value: str, out: str, descending: bool = False
) -> DataFrame:
    """Add the sum of ``value`` over the rows of the same keys that come before the row.

    ``order`` is unique within the keys; ``bucket`` must not decrease as ``order`` grows.
    """

    def before(*partition: str, by: str) -> WindowSpec:
        ordering = F.col(by).desc() if descending else F.col(by).asc()
        return W.partitionBy(*partition).orderBy(ordering).rowsBetween(W.unboundedPreceding, -1)

    bucketed = df.withColumn("_bucket", bucket)
    starts = (
        bucketed.groupBy(*keys, "_bucket")
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_sum").over(before(*keys, by="_bucket")), F.lit(0)).alias("_start"))
    )
    inside = F.coalesce(F.sum(value).over(before(*keys, "_bucket", by=order)), F.lit(0))
    return (
        _null_safe_join(bucketed, starts, [*keys, "_bucket"])
        .withColumn(out, F.col("_start") + inside)
        .drop("_bucket", "_start")
    )


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join on equal keys, of which two NULLs are equal too."""
    right = right.withColumnsRenamed({c: f"_right_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on]
    return left.join(right, same).drop(*[f"_right_{c}" for c in on])


def latest_rank(df: DataFrame, keys: list[str], order: str, bucket: Column, out: str) -> DataFrame:
    """``rank()`` over ``keys`` by ``order`` descending.

    Equal (keys, order) rows collapse to one counted row before anything is ordered; the rank then
    goes back to the rows by an equi-join.
    """
    counted = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_total(counted, keys, order, bucket, "_n", "_before", descending=True)
    ranks = ranks.select(*keys, order, (F.col("_before") + 1).alias(out))
    return _null_safe_join(df, ranks, [*keys, order])
