"""Catalog reports: documentation coverage, space, users."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.shares import with_share
from opsight.functions.times import day_of

MB = 1024 * 1024


def missing_comment_share(comments: DataFrame, scope: DataFrame, counted: str = "column_name") -> DataFrame:
    """Per schema in scope, its percentage of all undocumented columns (or tables), one decimal."""
    schemas = scope.where(F.col("include_ind") == 1).select(F.col("schema_name").alias("owner"))
    missing = comments.where(F.col("comments").isNull()).groupBy("owner").agg(F.count(counted).alias("_n"))
    return with_share(missing.join(schemas, "owner", "left_semi"), "_n", "pcnt", digits=1, factor=100).drop("_n")


def _bytes(files: DataFrame, out: str, column: str = "bytes") -> DataFrame:
    return files.groupBy("tablespace_name").agg(F.sum(column).alias(out))


def space_usage(spaces: DataFrame, data_files: DataFrame, free_space: DataFrame, temp_files: DataFrame,
                temp_headers: DataFrame) -> DataFrame:
    """Available, used and free MB and the used percentage of every space.

    Permanent spaces are what remains of their files after the free pieces; locally managed temporary
    spaces report use directly. Sides without a row count as 0. A space with unknown kind shows in
    neither branch.
    """
    local_temp = (F.col("extent_management") == "LOCAL") & (F.col("contents") == "TEMPORARY")
    shown = [
        "tablespace_name", "avail_mbs", "used_mbs", "free_mbs", "used_pct", "contents", "extent_management", "status",
    ]

    def none_is_zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0))

    avail = F.col("_avail")
    free = none_is_zero(F.col("_free"))
    permanent = (
        spaces.where(~local_temp)
        .join(_bytes(data_files, "_avail"), "tablespace_name", "left")
        .join(_bytes(free_space, "_free"), "tablespace_name", "left")
        .withColumn("avail_mbs", none_is_zero(avail / MB))
        .withColumn("used_mbs", none_is_zero(avail - free) / MB)
        .withColumn("free_mbs", none_is_zero(F.col("_free") / MB))
        .withColumn("used_pct", none_is_zero((avail - free) / F.when(avail != 0, avail) * 100))
    )
    used = F.col("_used")
    temporary = (
        spaces.where(local_temp)
        .join(_bytes(temp_files, "_avail"), "tablespace_name", "left")
        .join(_bytes(temp_headers, "_used", "bytes_used"), "tablespace_name", "left")
        .withColumn("avail_mbs", none_is_zero(avail / MB))
        .withColumn("used_mbs", none_is_zero(used) / MB)
        .withColumn("free_mbs", none_is_zero(avail - none_is_zero(used)) / MB)
        .withColumn("used_pct", none_is_zero(used / F.when(avail != 0, avail) * 100))
    )
    both = permanent.select(*shown).unionByName(temporary.select(*shown))
    return both.withColumn("used_pct", F.round("used_pct", 2))


def spaces_of_owners(tables: DataFrame, owners: list[str], negate: bool = False) -> DataFrame:
    """The spaces that hold a table of the owners, or of any other owner."""
    test = F.col("owner").isin(*owners)
    return tables.where(~test if negate else test).select("tablespace_name").distinct()


def space_by_area(usage: DataFrame, tables: DataFrame, owners: list[str], negate: bool = False) -> DataFrame:
    """Available MB of those spaces, one row. A space shared with other owners counts on both sides."""
    return usage.join(spaces_of_owners(tables, owners, negate), "tablespace_name", "left_semi").agg(
        F.sum("avail_mbs").alias("avail_mbs")
    )


def summary_size(segments: DataFrame, mviews: DataFrame) -> DataFrame:
    """MB of the segments that hold a materialized view, by name whatever the owner, one row."""
    names = mviews.select(F.col("container_name").alias("segment_name"))
    sizes = segments.groupBy("segment_name").agg(F.sum("bytes").alias("bytes"))
    return sizes.join(names, "segment_name", "left_semi").agg((F.sum("bytes") / MB).alias("mbs"))


def user_segment(users: DataFrame, day: date | None = None, profile: str | None = None,
                 view: str | None = None) -> DataFrame:
    """Users created on a day or having a profile; ``view`` also registers them under that name."""
    tests = []
    if day is not None:
        tests.append(day_of("created") == F.lit(day))
    if profile is not None:
        tests.append(F.col("profile") == profile)
    if not tests:
        raise ValueError("give a day or a profile")
    out = users.where(tests[0] if len(tests) == 1 else tests[0] | tests[1])
    if view:
        out.createOrReplaceTempView(view)
    return out


def pattern_lookup(df: DataFrame, column: str, like: str) -> DataFrame:
    """Catalog rows by name pattern."""
    return df.where(F.col(column).like(like))


def exact_lookup(df: DataFrame, column: str, value) -> DataFrame:
    """Catalog rows by exact value."""
    return df.where(F.col(column) == F.lit(value))
