"""Time spent in the phases of a load: extraction, transformation, loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from opsight.functions.times import UNIT_SECONDS, epoch_micros, minute_of, whole_units

MICROS = 1_000_000
OFFSET_RANGES = 60


def _starts(df: DataFrame, unit: str, count: str, *keys: str) -> DataFrame:
    """Runs counted per finish minute and start, the start split in whole units and the rest."""
    size = UNIT_SECONDS[unit] * MICROS
    offset = F.pmod(F.col("start"), F.lit(size))
    return (
        df.select(minute_of("updated_on").alias("minute"), epoch_micros("created_on").alias("start"), *keys)
        .where(F.col("minute").isNotNull() & F.col("start").isNotNull())
        .groupBy("minute", "start", *keys)
        .agg(F.count(F.lit(1)).alias(count))
        .select(
            "minute", *keys, count,
            ((F.col("start") - offset) / F.lit(size)).cast("bigint").alias("slot"),
            offset.alias("offset"),
        )
    )


def phase_between(first: DataFrame, second: DataFrame, unit: str = "hour") -> DataFrame:
    """Histogram of the time from the start of a first-phase run to the start of a second-phase run.

    Every first run is paired with every second run that finishes in the same minute; the duration
    is in whole units, cut toward zero, and the name is that of the first run.

    Pairs are counted, not built. With both starts written as slot * unit + offset, the whole-unit
    difference of a pair is the difference of the slots, or one nearer to or further from zero
    depending on the order of the offsets. So for each slot of the second runs a first run only needs
    the number of second runs below, at and above its own offset.

    That number is a running count over the offsets. It is taken inside narrow ranges of the offset,
    on top of the totals of the ranges before, so that one minute with very many finishes is spread
    over (slot, range) and no task has to order all of it.
    """
    width = UNIT_SECONDS[unit] * MICROS // OFFSET_RANGES

    def offset_range(offset: str):
        return ((F.col(offset) - F.pmod(F.col(offset), F.lit(width))) / F.lit(width)).cast("int")

    a = _starts(first, unit, "runs", "execution_name").withColumn("range", offset_range("offset"))
    b = _starts(second, unit, "others").withColumn("range", offset_range("offset"))
    slots = (
        b.groupBy("minute", F.col("slot").alias("to_slot"), "range")
        .agg(F.sum("others").alias("n"))
        .groupBy("minute", "to_slot")
        .agg(F.sum("n").alias("n_all"), F.collect_list(F.struct("range", "n")).alias("ranges"))
    )
    earlier = F.aggregate(
        F.filter("ranges", lambda r: r["range"] < F.col("range")), F.lit(0).cast("bigint"), lambda s, r: s + r["n"]
    )
    probes = a.join(slots, "minute").select(
        "minute", "to_slot", "range", "offset", "execution_name", (F.col("to_slot") - F.col("slot")).alias("d"),
        "runs", "n_all", earlier.alias("n_earlier"), F.lit(0).cast("bigint").alias("others"),
    )
    targets = b.select("minute", F.col("slot").alias("to_slot"), "range", "offset", "others")
    lane = W.partitionBy("minute", "to_slot", "range").orderBy("offset")
    upto = lane.rangeBetween(W.unboundedPreceding, W.currentRow)
    below = lane.rangeBetween(W.unboundedPreceding, -1)
    counted = (
        probes.unionByName(targets, allowMissingColumns=True)
        .select(
            "execution_name", "d", "runs", "n_all",
            (F.col("n_earlier") + F.sum("others").over(upto)).alias("n_upto"),
            (F.col("n_earlier") + F.coalesce(F.sum("others").over(below), F.lit(0))).alias("n_below"),
        )
        .where("runs IS NOT NULL")
    )
    d, runs, everything = F.col("d"), F.col("runs"), F.col("n_all")

    def piece(duration, pairs):
        return F.struct(duration.alias("duration"), (runs * pairs).alias("pairs"))

    pieces = (
        F.when(d > 0, F.array(piece(d, everything - F.col("n_below")), piece(d - 1, F.col("n_below"))))
        .when(d < 0, F.array(piece(d, F.col("n_upto")), piece(d + 1, everything - F.col("n_upto"))))
        .otherwise(F.array(piece(d, everything)))
    )
    return (
        counted.select("execution_name", F.explode(pieces).alias("p"))
        .where("p.pairs > 0")
        .groupBy("execution_name", F.col("p.duration").alias("duration"))
        .agg(F.sum("p.pairs").alias("frequency"))
    )


def phase_to_root_end(steps: DataFrame, executions: DataFrame, unit: str = "hour") -> DataFrame:
    """From the start of each step to the finish of its top-level run."""
    roots = executions.select(
        F.col("execution_audit_id").alias("top_level_execution_audit_id"), F.col("updated_on").alias("root_updated_on")
    )
    return (
        steps.select("execution_audit_id", "execution_name", "top_level_execution_audit_id", "created_on")
        .join(roots, "top_level_execution_audit_id")
        .select(
            "execution_audit_id", "execution_name", "created_on", F.col("root_updated_on").alias("updated_on"),
            whole_units("created_on", "root_updated_on", unit).alias("duration"),
        )
    )


def step_offset_from_root(steps: DataFrame, roots: DataFrame, unit: str = "hour") -> DataFrame:
    """From the start of the top-level run to the start of the step, with the number of all rows."""
    tops = roots.select(
        F.col("execution_audit_id").alias("top_level_execution_audit_id"), F.col("created_on").alias("root_created_on"),
        F.col("updated_on").alias("root_updated_on"),
    )
    joined = steps.select("execution_audit_id", "execution_name", "top_level_execution_audit_id", "created_on").join(
        tops, "top_level_execution_audit_id"
    )
    total = joined.agg(F.count(F.lit(1))).scalar()
    return joined.select(
        "execution_audit_id", "execution_name", "created_on", F.col("root_updated_on").alias("updated_on"),
        whole_units("root_created_on", "created_on", unit).alias("duration"), total.alias("tot_cnt"),
    )


def duration_counts(df: DataFrame) -> DataFrame:
    """Rows per name and duration: the histogram form of the two operators above."""
    return df.groupBy("execution_name", "duration").agg(F.count(F.lit(1)).alias("frequency"))


def trimmed_weighted_mean(hist: DataFrame, min_freq: int = 1, low: float = 0, high: float = 11, over: int = 20,
                          sentinel: int = -20) -> DataFrame:
    """Mean duration weighted by frequency, one row.

    Durations above ``over`` become one ``sentinel`` entry per name. An entry counts when its
    frequency exceeds ``min_freq`` and its duration lies strictly between ``low`` and ``high``.
    """
    folded = F.when(F.col("duration") > over, sentinel).otherwise(F.col("duration"))
    kept = (
        hist.groupBy("execution_name", folded.alias("duration"))
        .agg(F.sum("frequency").alias("frequency"))
        .where((F.col("frequency") > min_freq) & (F.col("duration") > low) & (F.col("duration") < high))
    )
    total = F.sum("frequency")
    mean = F.sum(F.col("duration") * F.col("frequency")) / F.when(total != 0, total)
    return kept.agg(mean.alias("mean_duration"))
