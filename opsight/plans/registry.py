"""Collects the queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from opsight.sources import derived as t

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The logical tables of one data folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.base: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        made = t.logical(self.spark, self.sf_dir, getattr(t, name), self.base)
        setattr(self, name, made)
        return made


def _plain_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which every engine's client shows alike."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in df.schema.fields
    ])


def query(name: str, tables: list[Callable] | None = None, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``; ``sql`` is its check over the listed logical tables."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _plain_dates(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = t.check_sql(tables or [], sql)
        return fn

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Shares as the checking SQL shows them, with six digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})
