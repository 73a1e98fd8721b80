"""Statement statistics of captured sessions.

Joining statistics to captured sessions repeats each statistics row once per matching session. The
repeats are equal, so they are kept as a number in ``matches``; ``expand`` writes them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsight.operators.capture import SESSION_KEYS, latest_per_key


def expand(df: DataFrame, count: str = "matches", portion: int = 1 << 16) -> DataFrame:
    """Each row as often as its number says, however large that is; none at all for 0, less or NULL.

    The copies are dealt out in portions, so no array is longer than ``portion`` or the number of portions.
    """
    copies, size = F.col(count).cast("long"), F.lit(portion).cast("long")
    portions = df.where(copies > 0).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1, size))
    )
    share = F.least(size, copies - F.col("_from")).cast("int")
    return portions.withColumn("_copy", F.explode(F.array_repeat(F.lit(True), share))).drop("_copy", "_from", count)


def _per_statement(sessions: DataFrame, weight: Column | None = None) -> DataFrame:
    """Sessions counted per statement, before any join with the statistics."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return sessions.where(F.col("sql_id").isNotNull()).groupBy("sql_id").agg(amount.alias("matches"))


def _result(stats: DataFrame, per_statement: DataFrame, mode: str) -> DataFrame:
    if mode == "distinct":
        return stats.join(per_statement.where("matches > 0"), "sql_id", "left_semi").select(*stats.columns)
    if mode != "counted":
        raise ValueError("mode is 'counted' or 'distinct'")
    return stats.join(per_statement, "sql_id").where("matches > 0").select(*stats.columns, "matches")


def tracked_sessions(snap: DataFrame) -> DataFrame:
    """One row per captured (session, statement, logon time), the newest."""
    return latest_per_key(
        snap, SESSION_KEYS, [F.col("population_date").desc_nulls_first(), F.col("fixed_table_sequence").desc()]
    )


def _pairs(snap: DataFrame) -> DataFrame:
    """The (session, statement) of each key; which row is the newest does not matter here."""
    return snap.select(*SESSION_KEYS).distinct()


def _captured(snap: DataFrame) -> DataFrame:
    """Captured rows counted per session and statement."""
    return snap.groupBy("sid", "sql_id").agg(F.count(F.lit(1)).alias("_captured"))


def stats_of_tracked(stats: DataFrame, snap: DataFrame, mode: str = "counted") -> DataFrame:
    """Statistics of the statements that some captured session ran."""
    return _result(stats, _per_statement(_pairs(snap)), mode)


def stats_of_finished(stats: DataFrame, snap: DataFrame, sessions: DataFrame, how: str = "anti",
                      mode: str = "counted") -> DataFrame:
    """Statistics of statements of sessions that are not running now.

    ``sessions`` is the present session list. Three forms, which differ:

    - ``not_in``: every captured row whose session is not in the list of active ones. A captured row
      without session id passes only when no session is active.
    - ``anti``: one row per captured key whose session is not active; a missing session id passes.
    - ``inactive``: every captured row joined to the sessions listed as not active, so sessions that
      have gone are lost.

    Active sessions without an id are ignored.
    """
    active = sessions.where(F.col("status") == "ACTIVE").select("sid").where(F.col("sid").isNotNull()).distinct()
    if how == "anti":
        chosen = _per_statement(_pairs(snap).join(active, "sid", "left_anti"))
    elif how == "not_in":
        some_active = active.agg(F.count(F.lit(1)) > 0).scalar()
        rows = _captured(snap).join(active, "sid", "left_anti")
        chosen = _per_statement(rows.where(F.col("sid").isNotNull() | ~some_active), F.col("_captured"))
    elif how == "inactive":
        listed = sessions.where(F.col("status") != "ACTIVE").groupBy("sid").agg(F.count(F.lit(1)).alias("_listed"))
        rows = _captured(snap).join(listed, "sid")
        chosen = _per_statement(rows, F.col("_captured") * F.col("_listed"))
    else:
        raise ValueError("how is 'not_in', 'anti' or 'inactive'")
    return _result(stats, chosen, mode)


def stats_other_sessions(stats: DataFrame, snap: DataFrame, sessions: DataFrame) -> DataFrame:
    """Statistics matched with every active session other than the one that ran the statement.

    Per captured row the partners are all active sessions less those with its own id, so two counts
    replace the join on inequality. Rows without partner or without session id do not show.
    """
    active = sessions.where((F.col("status") == "ACTIVE") & F.col("sid").isNotNull()).groupBy("sid").agg(
        F.count(F.lit(1)).alias("_same")
    )
    everyone = F.coalesce(active.agg(F.sum("_same")).scalar(), F.lit(0))
    rows = _captured(snap.where(F.col("sid").isNotNull())).join(active, "sid", "left")
    partners = F.col("_captured") * (everyone - F.coalesce(F.col("_same"), F.lit(0)))
    return _result(stats, _per_statement(rows.withColumn("_partners", partners), F.col("_partners")), "counted")
