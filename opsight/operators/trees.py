"""Parent/child hierarchies: tree walks, leaf steps and their history."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from opsight.functions.matching import short_name
from opsight.functions.times import moment, units_rounded
from opsight.operators.executions import successful
from opsight.session import cut_lineage

# Display names of the step types; other types have none.
STEP_TYPES = {"PLSQL": "Mapping", "PLSQLProcedure": "Procedure", "PLSQLFunction": "Function"}


def step_type(task_type: Column) -> Column:
    out = F
    for code, label in STEP_TYPES.items():
        out = out.when(task_type == code, label)
    return out.otherwise(F.lit(None).cast("string"))


def walk_from_roots(nodes: DataFrame, node: str, parent: str, segment: Column, root: Column,
                    max_rounds: int = 40) -> DataFrame:
    """Every node that a chain of parents joins to a root (a node without parent).

    Adds ``root`` (the given struct, taken at the root), ``level`` (1 at the root) and ``path`` (the
    segments from the root on; text or array, joined by ``concat``). ``node`` must be unique, and
    ``nodes`` is read once per round, so give it with its lineage cut.

    Each round joins every unfinished node with the node it points to and takes over that one's
    pointer, so the distance covered doubles: a tree of depth d needs about log2(d) rounds where a
    walk level by level needs d. A node whose ancestor is missing finds no partner and drops out.
    Nodes on a loop are reached from no root; they are given up when a round finishes nobody.
    """
    state = nodes.select(
        "*",
        F.when(F.col(parent).isNull(), root).alias("root"),
        F.lit(1).cast("bigint").alias("level"),
        segment.alias("path"),
        F.col(parent).alias("_to"),
    )
    finished = state.where(F.col("root").isNotNull())
    active = state.where(F.col("root").isNull())
    for _ in range(max_rounds):
        targets = finished.unionByName(active).select(
            F.col(node).alias("_node"), F.col("_to").alias("_next"), F.col("level").alias("_level"),
            F.col("path").alias("_path"), F.col("root").alias("_root"),
        )
        moved = cut_lineage(
            active.join(targets, active["_to"] == targets["_node"]).select(
                *nodes.columns,
                F.col("_root").alias("root"),
                (F.col("level") + F.col("_level")).alias("level"),
                F.concat("_path", "path").alias("path"),
                F.col("_next").alias("_to"),
            )
        )
        arrived = moved.where(F.col("root").isNotNull())
        finished = finished.unionByName(arrived)
        active = moved.where(F.col("root").isNull())
        counts = moved.agg(F.count("root").alias("arrived"), F.count(F.lit(1)).alias("moved")).first()
        if counts["arrived"] in (0, counts["moved"]):
            return finished.drop("_to")
    raise ValueError(f"the walk did not end within {max_rounds} rounds")


def with_leaf_flag(walked: DataFrame, nodes: DataFrame, node: str, parent: str) -> DataFrame:
    """Add ``is_leaf``: no row of ``nodes`` has the node as its parent."""
    parents = nodes.where(F.col(parent).isNotNull()).select(F.col(parent).alias("_parent")).distinct()
    return (
        walked.join(parents, F.col(node) == F.col("_parent"), "left")
        .withColumn("is_leaf", F.col("_parent").isNull())
        .drop("_parent")
    )


def flow_tree(executions: DataFrame, flows: DataFrame, since: datetime, flow_name: str | None = None,
              critical_ind: str | None = None) -> DataFrame:
    """The steps below each successful run of a known flow, with their place in the run.

    Only successful rows started after ``since`` are walked, so a failed step hides all that is
    below it. A flow whose ``critical_ind`` is NULL never passes.
    """
    chosen = flows.where(F.col("flow_name").isNotNull() & F.col("critical_ind").isNotNull())
    if flow_name is not None:
        chosen = chosen.where(F.col("flow_name") == flow_name)
    if critical_ind is not None:
        chosen = chosen.where(F.col("critical_ind") == critical_ind)
    good = successful(executions, since=since)
    tops = (
        good.where(F.col("parent_execution_audit_id").isNull())
        .join(chosen.select(F.col("flow_name").alias("execution_name")), "execution_name", "left_semi")
        .select(F.col("execution_audit_id").alias("top_level_execution_audit_id"))
    )
    nodes = cut_lineage(
        good.join(tops, "top_level_execution_audit_id", "left_semi").select(
            "execution_audit_id", "parent_execution_audit_id", "execution_name", "task_type", "created_on", "updated_on"
        )
    )
    short = short_name(F.col("execution_name"))
    root = F.struct(
        F.col("execution_audit_id").alias("id"), F.col("execution_name").alias("name"),
        F.col("created_on").alias("created_on"), F.col("updated_on").alias("updated_on"),
    )
    walked = walk_from_roots(
        nodes, "execution_audit_id", "parent_execution_audit_id", F.concat(F.lit("/"), short), root
    )
    return with_leaf_flag(walked, nodes, "execution_audit_id", "parent_execution_audit_id").select(
        F.col("root.id").alias("root_execution_audit_id"), "execution_audit_id", "execution_name",
        short.alias("execution_name_short"), "task_type", step_type(F.col("task_type")).alias("type"),
        "created_on", "updated_on",
        units_rounded("created_on", "updated_on", "minute").alias("duration_mins"),
        units_rounded("created_on", "root.updated_on", "minute").alias("mins_until_end_of_root"),
        F.col("root.name").alias("root_execution_name"),
        units_rounded("root.created_on", "root.updated_on", "hour").alias("root_duration_hrs"),
        F.col("root.created_on").alias("root_created_on"), F.col("root.updated_on").alias("root_updated_on"),
        "is_leaf", "level", "path",
    )


def heaviest_leaves(tree: DataFrame, n: int, types: list[str] | None = None) -> DataFrame:
    """The ``n`` longest leaf steps of the given types with their ranking; ties go to the lower id."""
    order = [F.col("duration_mins").desc_nulls_first(), F.col("execution_audit_id").asc()]
    top = (
        tree.where(F.col("is_leaf") & F.col("task_type").isin(*(types or STEP_TYPES)))
        .orderBy(*order)
        .limit(n)
    )
    # the window sees the n rows of the report only
    return top.withColumn("ranking", F.row_number().over(W.orderBy(*order)).cast("bigint"))


def heavy_leaf_history(top: DataFrame, executions: DataFrame, now: datetime, days_back: int) -> DataFrame:
    """All runs of those steps, by name, over the last days: by ranking, name, newest first."""
    wanted = top.select("execution_name", "ranking")
    hist = executions.where(F.col("created_on") > moment(now - timedelta(days=days_back)))
    return (
        hist.join(wanted, "execution_name")
        .select(
            "top_level_execution_audit_id", "execution_audit_id", "ranking",
            short_name(F.col("execution_name")).alias("execution_name_short"),
            step_type(F.col("task_type")).alias("type"), "created_on", "updated_on",
            units_rounded("created_on", "updated_on", "minute").alias("duration_mins"), "execution_name",
        )
        .orderBy("ranking", "execution_name", F.col("created_on").desc_nulls_first())
        .drop("execution_name")
    )


def hierarchy_depth_first(df: DataFrame, node: str = "employee_id", parent: str = "manager_id",
                          label: str = "last_name") -> DataFrame:
    """Level and indented label of every node below a root, depth first, siblings by label.

    A node without a label comes last among its siblings and shows its indentation only.
    """
    key = F.array(F.struct(F.col(label).isNull().alias("none"), F.col(label).alias("label"), F.col(node).alias("id")))
    nodes = cut_lineage(df.select(node, parent, label))
    walked = walk_from_roots(nodes, node, parent, key, F.struct(F.col(node).alias("id")))
    return walked.orderBy("path").select(
        node, "level", F.concat(F.repeat(F.lit("*"), (F.col("level") * 2).cast("int")), F.coalesce(label, F.lit(""))).alias("label")
    )


def number_rows(spark: SparkSession, n: int) -> DataFrame:
    """Rows 1 to n."""
    return spark.range(1, n + 1).withColumnRenamed("id", "n")
