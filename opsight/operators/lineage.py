"""From materialized views to the views, tables and columns they are made of."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.matching import like_any
from opsight.functions.times import moment
from opsight.operators.contains import confirmed_pairs, contains_pairs
from opsight.session import cut_lineage

# Owners whose tables count.
TABLE_OWNERS = ["%_DW", "%_PERIF"]


def _literal_runs(pattern: Column) -> Column:
    """The pieces of a LIKE pattern between its wildcards."""
    return F.filter(F.split(pattern, "[_%]+"), lambda p: p != "")


def mentioned_names(lines: DataFrame, text: str, patterns: DataFrame, pattern: str) -> DataFrame:
    """The patterns that some line holds, upper-cased; ``_`` and ``%`` in a pattern are wildcards.

    Each pattern is looked up by its rarest literal piece (fewest patterns have it, then the
    longest) and confirmed with LIKE against the whole line.
    """
    lines = lines.select(F.upper(text).alias("_line")).where("_line IS NOT NULL").distinct()
    pieces = patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct().select(
        pattern, F.explode(_literal_runs(F.col(pattern))).alias("_piece")
    )
    spread = pieces.groupBy("_piece").agg(F.countDistinct(pattern).alias("_n"))
    anchors = cut_lineage(
        pieces.join(spread, "_piece")
        .groupBy(pattern)
        .agg(F.min_by("_piece", F.struct("_n", -F.char_length("_piece"), "_piece")).alias("_piece"))
    )
    hits = contains_pairs(lines, ["_line"], "_line", anchors, "_piece")
    wanted = F.concat(F.lit("%"), F.replace(F.col(pattern), F.lit("\\"), F.lit("\\\\")), F.lit("%"))
    held = F.call_function("like", F.col("_line"), wanted)
    return hits.join(anchors, "_piece").where(held).select(pattern).distinct()


def refreshed_views(analysis: DataFrame, relations: DataFrame, source: DataFrame, package: str,
                    now: datetime) -> DataFrame:
    """Materialized views refreshed this month that a package mentions, with the views they read."""
    month = datetime(now.year, now.month, 1)
    recent = analysis.where(F.col("last_refresh_date").between(moment(month), moment(now))).select(
        "owner", "mview_name", F.concat("owner", F.lit("."), "mview_name").alias("_full")
    )
    lines = source.where(F.col("name") == package)
    named = mentioned_names(lines, "text", recent, "_full")
    return (
        recent.join(named, "_full", "left_semi")
        .join(relations, ["owner", "mview_name"])
        .select(
            F.col("owner").alias("mview_owner"), "mview_name", F.col("detailobj_owner").alias("view_owner"),
            F.col("detailobj_name").alias("view_name"),
        )
    )


def _texts(views: DataFrame) -> DataFrame:
    return views.select(F.col("owner").alias("view_owner"), "view_name", "text")


def view_table_lineage(views: DataFrame, mviews: DataFrame, tables: DataFrame,
                       owners_like: list[str] | None = None) -> DataFrame:
    """The tables whose ``OWNER.TABLE`` occurs in the text of a view, per materialized view.

    The search is for the characters as they are: case matters, and a longer name also holds every
    shorter name it starts with. Texts are searched whole, at any length.
    """
    patterns = TABLE_OWNERS if owners_like is None else owners_like
    names = tables.where(like_any(F.col("owner"), patterns)).select(
        F.col("owner").alias("table_owner"), "table_name", F.concat("owner", F.lit("."), "table_name").alias("_full")
    )
    key = ["view_owner", "view_name"]
    texts = _texts(views).join(mviews.select(*key).distinct(), key, "left_semi")
    pairs = contains_pairs(texts, key, "text", names, "_full")
    return (
        pairs.join(names, "_full")
        .join(mviews, key)
        .select("mview_owner", "mview_name", *key, "table_owner", "table_name")
    )


def view_column_lineage(lineage: DataFrame, columns: DataFrame, views: DataFrame) -> DataFrame:
    """The columns of those tables whose name occurs in the text of the view.

    Each text is read once, next to the different names of all its tables' columns.
    """
    view = ["view_owner", "view_name"]
    names = columns.select(F.col("owner").alias("table_owner"), "table_name", F.col("column_name").alias("col_name"))
    # read twice: for the names of each text, and to put what is found back to its tables
    wanted = cut_lineage(lineage.join(names, ["table_owner", "table_name"]))
    held = confirmed_pairs(wanted, view, "col_name", _texts(views), "text")
    return wanted.join(held, [*view, "col_name"]).select(
        "mview_owner", "mview_name", *view, "table_owner", "table_name", "col_name")
