"""Histograms over durations and elapsed times."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.banding import BandSpec, ELAPSED_LEGACY, HOURS_COARSE, MINUTES_SHORT, capped
from opsight.functions.shares import with_share, with_share_within
from opsight.functions.times import moment, whole_units


def _counted(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("frequency"))


def _duration(unit: str) -> Column:
    return whole_units("created_on", "updated_on", unit)


def duration_histogram(df: DataFrame, unit: str = "hour", cap: int = 10) -> DataFrame:
    """Runs per flow and whole duration, with the share of all given runs."""
    return with_share(_counted(df, "execution_name", capped(_duration(unit), cap).alias("duration_time_band")),
                      "frequency", "prcnt")


def duration_bands(df: DataFrame, bands: BandSpec, unit: str = "minute") -> DataFrame:
    """Runs per flow and named band, with the share of all given runs."""
    return with_share(_counted(df, "execution_name", bands.label(_duration(unit)).alias("duration_time_band")),
                      "frequency", "prcnt")


def before_after_bands(df: DataFrame, change_point: datetime, bands: BandSpec = MINUTES_SHORT,
                       unit: str = "minute") -> DataFrame:
    """The band histogram on both sides of a change. A run at the very moment is on neither side;
    shares are of the runs of the same side."""
    at = moment(change_point)
    side = F.when(F.col("created_on") < at, "before").when(F.col("created_on") > at, "after")
    grouped = _counted(
        df.where(F.col("created_on") != at), side.alias("side"), "execution_name",
        bands.label(_duration(unit)).alias("duration_time_band"),
    )
    return with_share_within(grouped, ["side"], "frequency", "prcnt")


def rebanded_histogram(df: DataFrame, bands: BandSpec | None = HOURS_COARSE, unit: str = "hour") -> DataFrame:
    """The plain histogram per flow and whole duration; with bands, its frequencies summed per band."""
    plain = _counted(df, "execution_name", _duration(unit).alias("duration"))
    if bands is None:
        return plain
    return plain.groupBy(bands.label(F.col("duration")).alias("elpsd_time_band")).agg(
        F.sum("frequency").alias("freq")
    )


def tag_elapsed_band(df: DataFrame, column: str, bands: BandSpec) -> DataFrame:
    """All rows and columns with the band label added."""
    return df.withColumn("elpsd_time_band", bands.label(F.col(column)))


def elapsed_band_share(df: DataFrame, column: str, bands: BandSpec = ELAPSED_LEGACY) -> DataFrame:
    """Rows per band and their share of all rows."""
    grouped = df.groupBy(bands.label(F.col(column)).alias("elpsd_time_band")).agg(
        F.count(F.lit(1)).alias("num_of_selects_per_band")
    )
    return with_share(grouped, "num_of_selects_per_band", "prcnt_of_total_queries")
