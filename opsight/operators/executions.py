"""The flow execution log: column names, successful runs, latest runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from opsight.functions.matching import any_of, like_any
from opsight.functions.times import moment

COLUMNS = [
    "execution_audit_id", "parent_execution_audit_id", "top_level_execution_audit_id", "execution_name", "task_type",
    "created_on", "updated_on", "execution_audit_status", "return_result",
]

# Column names of the log under its three vocabularies.
VOCABULARIES = {
    "view": {},
    "base": {
        "audit_execution_id": "execution_audit_id",
        "parent_audit_execution_id": "parent_execution_audit_id",
        "top_level_audit_execution_id": "top_level_execution_audit_id",
        "task_name": "execution_name",
        "creation_date": "created_on",
        "last_update_date": "updated_on",
    },
    "mixed": {
        "audit_execution_id": "execution_audit_id",
        "parent_audit_execution_id": "parent_execution_audit_id",
        "top_level_audit_execution_id": "top_level_execution_audit_id",
        "task_name": "execution_name",
    },
}

# What marks a run as completed without error.
COMPLETE, OK = "COMPLETE", "OK"


def normalize_executions(df: DataFrame, vocabulary: str = "view") -> DataFrame:
    """Bring the log to the common column names.

    Columns beyond the known ones (such as the stored elapsed time) follow unchanged; known columns
    the vocabulary lacks are left out. The key, the name and the two times must be there.
    """
    renames = VOCABULARIES[vocabulary]
    out = df.select(*[F.col(c).alias(renames.get(c.lower(), c.lower())) for c in df.columns])
    required = {"execution_audit_id", "execution_name", "created_on", "updated_on"}
    missing = required - set(out.columns)
    if missing:
        raise ValueError(f"columns missing under vocabulary {vocabulary!r}: {sorted(missing)}")
    known = [c for c in COLUMNS if c in out.columns]
    return out.select(*known, *[c for c in out.columns if c not in known])


def named(df: DataFrame, names: list[str] | None = None, like: list[str] | None = None,
          column: str = "execution_name") -> DataFrame:
    """Rows whose name is listed or fits a pattern; without either, all rows."""
    tests = []
    if names:
        tests.append(F.col(column).isin(*names))
    if like:
        tests.append(like_any(F.col(column), like))
    return df.where(any_of(tests)) if tests else df


def successful(
    df: DataFrame, names: list[str] | None = None, like: list[str] | None = None, since: datetime | None = None,
    until: datetime | None = None, roots_only: bool = False,
) -> DataFrame:
    """Completed runs without error. Both time bounds are strict."""
    out = named(df, names, like).where(
        (F.col("execution_audit_status") == COMPLETE) & (F.col("return_result") == OK)
    )
    if since is not None:
        out = out.where(F.col("created_on") > moment(since))
    if until is not None:
        out = out.where(F.col("created_on") < moment(until))
    if roots_only:
        out = out.where(F.col("parent_execution_audit_id").isNull())
    return out


def latest_runs(df: DataFrame, like: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """The log of the matching runs, newest id first, whole or the first ``limit`` rows."""
    out = named(df, like=like).orderBy(F.col("execution_audit_id").desc())
    return out.limit(limit) if limit is not None else out
