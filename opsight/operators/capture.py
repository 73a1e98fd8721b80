"""Snapshot capture of sessions: which rows to take, and when to start over."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opsight.functions.matching import like_any
from opsight.functions.times import moment

# Key of a captured session, start used when nothing was captured yet, the accounts of
# the database itself, and the program name pattern of parallel workers.
SESSION_KEYS = ["sid", "sql_id", "logon_time"]
NEVER = datetime(1900, 1, 1)
SYSTEM_SCHEMAS = ["SYS", "SYSTEM", "SYSMAN", "SYSADMIN"]
WORKER_PROGRAM = r"(P\d\d\d)"
INSERT_COMMAND = 2
# Program patterns of the older allow-list rule.
ALLOWED_PROGRAMS = ["%ReportServer%", "%busobj%", "%TOAD%", "%SQLNav%", "%sqlplus%"]


@dataclass(frozen=True)
class SessionRules:
    """Which sessions of known users count.

    ``deny_program`` drops programs by regular expression and keeps sessions without a program;
    ``allow_programs`` keeps only the listed LIKE patterns, so those without one go; ``command``
    restricts to one command.
    """

    system_schemas: tuple[str, ...] = tuple(SYSTEM_SCHEMAS)
    deny_program: str | None = WORKER_PROGRAM
    allow_programs: tuple[str, ...] = ()
    command: int | None = None

    def test(self) -> Column:
        out = F.col("status") == "ACTIVE"
        if self.system_schemas:
            out = out & ~F.col("schemaname").isin(*self.system_schemas)
        if self.deny_program:
            out = out & ~F.coalesce(F.col("program"), F.lit("OK")).rlike(self.deny_program)
        if self.allow_programs:
            out = out & like_any(F.col("program"), list(self.allow_programs))
        if self.command is not None:
            out = out & (F.col("command") == self.command)
        return out


CURRENT_RULES = SessionRules()
FIRST_RULES = SessionRules((), None, tuple(ALLOWED_PROGRAMS[:2]), 3)
ALLOW_LIST_RULES = SessionRules((), None, tuple(ALLOWED_PROGRAMS), None)


def eligible_sessions(sessions: DataFrame, users: DataFrame, rules: SessionRules = CURRENT_RULES) -> DataFrame:
    """Active sessions whose user id and schema both belong to known users."""
    return (
        sessions.where(rules.test())
        .join(users.select("user_id"), "user_id", "left_semi")
        .join(users.select(F.col("username").alias("schemaname")), "schemaname", "left_semi")
        .select(*sessions.columns)
    )


def _mark(snap: DataFrame, epoch: Column) -> Column:
    """Change counter of the newest captured row of this instance start; NULL without one."""
    newest = F.max_by("fixed_table_sequence", F.struct("population_date", "fixed_table_sequence"))
    return snap.where(F.col("instance_startup_date") == epoch).agg(newest).scalar()


def changed_since_hwm(source: DataFrame, snap: DataFrame, epoch: datetime | Column) -> DataFrame:
    """Source rows whose change counter is above that of the newest captured row of the instance.

    Without such a row the comparison is unknown and no row passes. The mark is a scalar subquery:
    one aggregate over the snapshot, then a filter that reaches the source scan.
    """
    return source.where(F.col("fixed_table_sequence") > _mark(snap, moment(epoch)))


def capture_with_epoch_reset(
    sessions: DataFrame, users: DataFrame, snap: DataFrame, now: datetime, epoch: datetime | Column,
    rules: SessionRules = CURRENT_RULES, monitor_user: str = "MONITOR",
) -> DataFrame:
    """The rows one capture takes, stamped with the capture time and the instance start.

    After a restart (the instance start differs from the last captured one, or nothing was captured)
    all eligible sessions are taken, plus the monitor's own active insert as a marker, and
    ``is_init`` is true. Otherwise only eligible rows changed since the mark.
    """
    at = moment(epoch)
    last = F.coalesce(snap.agg(F.max("instance_startup_date")).scalar(), moment(NEVER))
    restarted = at != last
    changed = F.coalesce(F.col("fixed_table_sequence") > _mark(snap, at), F.lit(False))
    marker = (
        (F.col("username") == monitor_user) & (F.col("command") == INSERT_COMMAND) & (F.col("status") == "ACTIVE")
    )
    known_ids = users.select(F.col("user_id").alias("_known_id")).distinct()
    known_names = users.select(F.col("username").alias("_known_name")).distinct()
    flagged = (
        sessions.where(F.col("status") == "ACTIVE")
        .join(known_ids, F.col("user_id") == F.col("_known_id"), "left")
        .join(known_names, F.col("schemaname") == F.col("_known_name"), "left")
    )
    eligible = (
        rules.test() & F.col("_known_id").isNotNull() & F.col("_known_name").isNotNull()
    )
    take = (eligible & (restarted | changed)) | (marker & restarted)
    rest = [c for c in sessions.columns if c not in ("population_date", "instance_startup_date")]
    return flagged.where(take).select(
        *rest, moment(now).alias("population_date"), at.alias("instance_startup_date"), restarted.alias("is_init")
    )


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key and task before the shuffle, so a hot key costs no more than a rare one.
    """
    first = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row", first).where("_row = 1").drop("_row")
