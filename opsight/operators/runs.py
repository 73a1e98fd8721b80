"""One whole capture: sessions first, then statement statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsight.operators.capture import CURRENT_RULES, SessionRules, capture_with_epoch_reset
from opsight.operators.upsert import upsert_sessions, upsert_statement_stats
from opsight.session import cut_lineage


def capture_run(
    sessions: DataFrame, users: DataFrame, session_snap: DataFrame, statements: DataFrame, statement_snap: DataFrame,
    now: datetime, epoch: datetime | Column, rules: SessionRules = CURRENT_RULES, exclude_text: str | None = None,
    on_duplicate: str = "error", newest_snap: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Both tables after the capture. Write the first before the second, each as a new version.

    The captured rows of both are fixed first, so the two merges see one moment. ``newest_snap`` is the part of
    ``session_snap`` that the marks are read from, as ``snapshots.read_newest`` gives it; None reads all of it.
    """
    marked = session_snap if newest_snap is None else newest_snap
    batch = cut_lineage(capture_with_epoch_reset(sessions, users, marked, now, epoch, rules))
    statements = cut_lineage(statements)
    newest = [F.col("fixed_table_sequence").desc()]
    return (
        upsert_sessions(session_snap, batch, on_duplicate, newest),
        upsert_statement_stats(
            statement_snap, statements, exclude_text, on_duplicate=on_duplicate,
            order=[F.col("population_date").desc_nulls_first()],
        ),
    )
