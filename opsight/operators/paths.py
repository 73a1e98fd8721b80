"""Chains of steps that follow each other, and the chain that takes longest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.matching import any_of, plain_number
from opsight.operators.trees import with_leaf_flag
from opsight.session import cut_lineage, scratch_path

# Junction nodes by name. With several predecessors they are no real "previous step".
JUNCTIONS = [r"^\s*AND(\d|_)+.*", r"^\s*OR(\d|_)+.*"]
ARROW = " -->"


def step_label() -> Column:
    """Name, duration, its 80th percentile and type, as shown in a path; NULL parts show empty."""
    def text(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    return F.concat(
        text(F.col("execution_name_short")), F.lit(" ["), text(plain_number(F.col("duration_mins"))), F.lit(", p80-"),
        text(plain_number(F.col("p80_duration_mins"))), F.lit(", TYPE:"), text(F.col("type")), F.lit("]"),
    )


THIS, PREVIOUS = "execution_audit_id", "prev_execution_audit_id"


def _is_start(start: Column | None) -> Column:
    return F.coalesce(F.col("prev_created_on").isNull() if start is None else start, F.lit(False))


def _label(label: Column | None) -> Column:
    return F.concat(F.lit(ARROW), label if label is not None else step_label())


def _shown() -> Column:
    """Rows that show: they have a previous step, and not a junction where they have several."""
    name = F.col("prev_execution_name_short")
    several = F.coalesce(F.col("cnt") > 1, F.lit(False))
    return F.coalesce(name.isNotNull() & ~(several & any_of([name.rlike(p) for p in JUNCTIONS])), F.lit(False))


def _grow(rows: DataFrame, joined: dict[str, Column], reduce=None, max_rounds: int = 40) -> DataFrame:
    """Grow chains from single steps to whole chains that begin at a start step.

    ``rows`` holds a step and its chain so far: ``step_ids``, ``_to`` (the step the chain points to)
    and ``_start``. A round appends every unfinished chain to the chains that end at the step it
    points to, so the length doubles and about log2 of the longest chain rounds are enough. Columns
    of the front piece are named with a leading ``_``; ``joined`` says how both pieces combine. A
    chain never passes a step twice.
    """
    finished = rows.where("_start").withColumn("_to", F.lit(None).cast("bigint")).drop("_start")
    active = rows.where("_to IS NOT NULL").drop("_start")
    columns = [c for c in rows.columns if c != "_start"]
    for _ in range(max_rounds):
        front = finished.unionByName(active).select(*[F.col(c).alias(f"_{c}") for c in columns])
        pairs = active.join(
            front, (F.col("_to") == F.col(f"_{THIS}")) & ~F.arrays_overlap(F.col("step_ids"), F.col("_step_ids"))
        )
        moved = pairs.select(*[
            F.col("__to").alias("_to") if c == "_to"
            else F.concat("_step_ids", "step_ids").alias(c) if c == "step_ids"
            else joined[c].alias(c) if c in joined else F.col(c)
            for c in columns
        ])
        moved = cut_lineage(reduce(moved) if reduce else moved)
        finished = finished.unionByName(moved.where("_to IS NULL"))
        active = moved.where("_to IS NOT NULL")
        if active.isEmpty():
            return finished.drop("_to")
    raise ValueError(f"the chains did not end within {max_rounds} rounds")


def sequence_paths(steps: DataFrame, start: Column | None = None, label: Column | None = None) -> DataFrame:
    """Every chain of predecessors from a start step to each step.

    Adds the readable path, the number of steps, the summed minutes (NULL when a step has none), the
    minutes of the last two steps together and the step ids. Chains are built whole and rows filtered
    afterwards: a step with several predecessors does not show the chain through a junction, and
    chains of a single step do not show at all, as they have no previous step.

    The number of chains can grow exponentially where branches meet; ``critical_chains`` does not
    build them.
    """
    rows = cut_lineage(
        with_leaf_flag(steps, steps, THIS, PREVIOUS).select(
            "*",
            F.lit(1).cast("bigint").alias("seq_length"),
            _label(label).alias("seq_path"),
            F.col("duration_mins").alias("path_duration_mins"),
            F.lit(None).cast("double").alias("pair_duration_mins"),
            F.array(THIS).alias("step_ids"),
            F.col(PREVIOUS).alias("_to"),
            _is_start(start).alias("_start"),
        )
    )
    chains = _grow(rows, {
        "seq_length": F.col("seq_length") + F.col("_seq_length"),
        "seq_path": F.concat("_seq_path", "seq_path"),
        "path_duration_mins": F.col("path_duration_mins") + F.col("_path_duration_mins"),
        "pair_duration_mins": F.when(F.col("seq_length") == 1, F.col("duration_mins") + F.col("_duration_mins"))
        .otherwise(F.col("pair_duration_mins")),
    })
    return (
        chains.where(_shown())
        .withColumn("path_duration_mins", F.round("path_duration_mins", 6))
        .withColumn("pair_duration_mins", F.round("pair_duration_mins", 6))
    )


def critical_path(paths: DataFrame, root: str = "root_created_on") -> DataFrame:
    """Per root start the chain with the largest sum; ties go to the longer chain, then the higher ids.

    Also the greatest length and sum over all chains of the root. Chains with an unknown duration
    cannot win; a root that has no other shows nothing.
    """
    mins, length = F.col("path_duration_mins"), F.col("seq_length")
    winner = F.struct(
        mins.alias("path_duration_mins"), length.alias("seq_length"), F.col("step_ids"),
        F.col("seq_path").alias("critical_path"), F.col("root_execution_name"),
        F.col("top_level_execution_audit_id"), F.col("root_updated_on"),
    )
    return (
        paths.groupBy(root)
        .agg(
            F.max(F.when(mins.isNotNull(), winner)).alias("w"),
            F.max(length).alias("max_length"),
            F.max(mins).alias("max_path_dur_mins"),
        )
        .where("w IS NOT NULL")
        .select(
            "w.root_execution_name", "w.top_level_execution_audit_id", root, "w.root_updated_on",
            "w.path_duration_mins", "w.seq_length", "w.critical_path", "max_length", "max_path_dur_mins",
        )
    )


def _written(df: DataFrame) -> DataFrame:
    """``df`` from a table in the shared folder, so that plans of many rounds go by its real size; sizes that are
    estimated from round to round multiply."""
    path = scratch_path(df.sparkSession, "links")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _splice(links: DataFrame) -> DataFrame:
    """(step, _a, _b): steps with one link in and one link out, no two of them neighbours, that a link from
    ``_a`` to ``_b`` can stand for."""
    into = links.groupBy(F.col("_b").alias("_step")).agg(F.count(F.lit(1)).alias("n_in"), F.min("_a").alias("_a"))
    out = links.groupBy(F.col("_a").alias("_step")).agg(F.count(F.lit(1)).alias("n_out"), F.min("_b").alias("_b"))
    inner = _written(
        into.join(out, "_step").where("n_in = 1 AND n_out = 1 AND _a != _step").select("_step", "_a", "_b")
    )
    turn = F.struct(F.xxhash64("_step"), F.col("_step"))
    # of neighbours the one with the greater hash goes, a third of a run on average
    around = inner.select(F.col("_step").alias("_a"), turn.alias("turn_a"))
    behind = inner.select(F.col("_step").alias("_b"), turn.alias("turn_b"))
    return inner.join(around, "_a", "left").join(behind, "_b", "left").where(
        F.coalesce(turn > F.col("turn_a"), F.lit(True)) & F.coalesce(turn > F.col("turn_b"), F.lit(True))
    ).select("_step", "_a", "_b")


def _loop_steps(rows: DataFrame) -> DataFrame | None:
    """Steps on a loop of predecessors, or on a way from one loop to another; None where there is no loop.

    Every loop has a link from a step to one with the same or a lower id, and its steps lie between the
    lowest and the highest of such links. Without such a link one aggregate is all it costs. Of the links
    in that range those without a link before or after them fall away. In the same round a step between
    just two links gives way to one link, about a third of a run at a time, so a run of n steps is gone
    after some log n rounds and the links shrink with each. What is left holds loops. The steps that gave
    way are then looked at last to first: one belongs to the result if both ends of its link do.
    """
    links = rows.select(F.col(PREVIOUS).alias("_a"), F.col(THIS).alias("_b")).where("_a IS NOT NULL AND _b IS NOT NULL")
    low, high = links.where("_a >= _b").agg(F.min("_b"), F.max("_a")).first()
    if low is None:
        return None
    links = _written(links.where(F.col("_a").between(low, high) & F.col("_b").between(low, high)).distinct())
    given, before, count = [], -1, links.count()
    while count and count != before:
        ends, begins = links.select(F.col("_b").alias("_a")), links.select(F.col("_a").alias("_b"))
        links = _written(links.join(ends, "_a", "left_semi").join(begins, "_b", "left_semi"))
        gone = _written(_splice(links))
        if not gone.isEmpty():
            given.append(gone)
            steps = gone.select("_step")
            links = _written(
                links.join(steps, F.col("_a") == F.col("_step"), "left_anti")
                .join(steps, F.col("_b") == F.col("_step"), "left_anti")
                .unionByName(gone.select("_a", "_b")).distinct()
            )
        before, count = count, links.count()
    if not count:
        return None
    looped = links.select(F.col("_a").alias(THIS)).distinct()
    for gone in reversed(given):
        first, last = looped.withColumnRenamed(THIS, "_a"), looped.withColumnRenamed(THIS, "_b")
        looped = _written(looped.unionByName(
            gone.join(first, "_a", "left_semi").join(last, "_b", "left_semi").select(F.col("_step").alias(THIS))
        ))
    return looped


def critical_chains(steps: DataFrame, start: Column | None = None, label: Column | None = None,
                    root: str = "root_created_on") -> DataFrame:
    """``critical_path`` straight from the steps, without building every chain.

    Of the pieces with the same end, pointer, number of steps and steps on loops only the one with the
    largest sum stays: longer chains extend all of them alike, as a chain can meet only steps on loops
    twice, so the largest sum and the greatest length per root come out the same. Without loops the
    pieces are as few as (end, pointer, length); each step on a loop adds to that. The rounds carry numbers only; the
    readable path is put together for the winning chains at the end. (Step, previous step)
    identifies a row; of several the greatest text shows.
    """
    rows = cut_lineage(
        steps.select(
            THIS, PREVIOUS, root, _shown().alias("_show"), F.lit(1).cast("bigint").alias("seq_length"),
            F.col("duration_mins").alias("mins"), F.array(THIS).alias("step_ids"), F.col(PREVIOUS).alias("_to"),
            _is_start(start).alias("_start"),
        )
    )
    looped = _loop_steps(rows)
    rows = rows.withColumn("loop_ids", F.array().cast("array<bigint>")) if looped is None else rows.join(
        looped.withColumn("_looped", F.lit(True)), THIS, "left"
    ).withColumn("loop_ids", F.when(F.col("_looped"), F.array(THIS)).otherwise(F.array().cast("array<bigint>"))).drop("_looped")

    def best(pieces: DataFrame) -> DataFrame:
        keys = [THIS, PREVIOUS, "_to", "seq_length", root, "_show", "loop_ids"]
        return pieces.groupBy(*keys).agg(F.max(F.struct("mins", "step_ids")).alias("b")).select(
            *keys, "b.mins", "b.step_ids"
        ).select(*pieces.columns)

    chains = _grow(rows, {
        "seq_length": F.col("seq_length") + F.col("_seq_length"), "mins": F.col("mins") + F.col("_mins"),
        "loop_ids": F.array_sort(F.concat("_loop_ids", "loop_ids")),
    }, best)
    mins = F.round("mins", 6)
    won = (
        chains.where("_show")
        .groupBy(root)
        .agg(
            F.max(F.when(F.col("mins").isNotNull(), F.struct(mins.alias("mins"), "seq_length", "step_ids"))).alias("w"),
            F.max("seq_length").alias("max_length"),
            F.max(mins).alias("max_path_dur_mins"),
        )
        .where("w IS NOT NULL")
        .select(root, "w.*", "max_length", "max_path_dur_mins")
    )
    result = [root, "mins", "seq_length", "max_length", "max_path_dur_mins"]
    places = won.select(*result, F.posexplode("step_ids").alias("place", "_step"), "step_ids").select(
        *result, "place", "_step", F.when(F.col("place") > 0, F.get("step_ids", F.col("place") - 1)).alias("_before")
    )
    shown = ["root_execution_name", "top_level_execution_audit_id", "root_updated_on"]
    texts = steps.select(THIS, PREVIOUS, _label(label).alias("text"), *shown, _is_start(start).alias("_start"))
    texts = texts.where("_start").withColumn(PREVIOUS, F.lit(None).cast("bigint")).unionByName(
        texts.where(F.col(PREVIOUS).isNotNull())
    ).drop("_start")
    text_in_order = F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda p: p["text"])
    return (
        places.join(texts, (F.col("_step") == F.col(THIS)) & F.col("_before").eqNullSafe(F.col(PREVIOUS)))
        .groupBy(*result, "place")
        .agg(F.max(F.struct("text", *shown)).alias("at"))
        .select(*result, "place", "at.*")
        .groupBy(*result)
        .agg(F.concat_ws("", text_in_order).alias("critical_path"), F.max_by(F.struct(*shown), "place").alias("end"))
        .select(
            "end.root_execution_name", "end.top_level_execution_audit_id", root, "end.root_updated_on",
            F.col("mins").alias("path_duration_mins"), "seq_length", "critical_path", "max_length",
            "max_path_dur_mins",
        )
    )
