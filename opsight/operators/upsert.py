"""Merging a batch into a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opsight.functions.matching import like_any
from opsight.functions.times import moment
from opsight.operators.capture import SESSION_KEYS, latest_per_key

# Key of captured statement statistics, and the one of the older insert-only form.
STATEMENT_KEYS = ["sql_id", "sql_text", "instance_startup_date"]
STATEMENT_KEYS_OLD = ["sql_id", "sql_text"]


def _all_known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], on_duplicate: str = "error",
    order: list[Column] | None = None, null_safe_keys: bool = False,
) -> DataFrame:
    """The target after the merge: matched rows take all values of the batch, other batch rows are added.

    A NULL key part matches nothing, so such batch rows are always added; ``null_safe_keys`` lets
    NULL match NULL. A target row matched by two batch rows is an error, raised while the result is
    computed, unless ``on_duplicate="latest"`` first keeps the first batch row per key in ``order``.

    One shuffle of both sides by the key, none of the target when the batch is small. The batch is
    counted per key first, so a key that fills much of the batch reaches the join as one row. The
    batch is read more than once: give it landed or with its lineage cut.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError("on_duplicate is 'error' or 'latest'")
    batch = batch.select(*target.columns)
    matching = batch if null_safe_keys else batch.where(_all_known(keys))
    counted = matching.groupBy(*keys).agg(F.count(F.lit(1)).alias("_matches"))
    renamed = counted.select(*[F.col(k).alias(f"_{k}") for k in keys], "_matches")
    same = [
        target[k].eqNullSafe(renamed[f"_{k}"]) if null_safe_keys else target[k] == renamed[f"_{k}"] for k in keys
    ]
    if on_duplicate == "latest":
        if not order:
            raise ValueError("'latest' needs an order")
        added = latest_per_key(matching, keys, order)
        if not null_safe_keys:
            added = added.unionByName(batch.where(~_all_known(keys)))
        return target.join(renamed, same, "left_anti").unionByName(added)
    stays = (
        F.when(F.col("_matches") > 1, F.raise_error(F.lit("a target row is matched by several batch rows")))
        .otherwise(F.col("_matches").isNull())
    )
    kept = target.join(renamed, same, "left").where(stays).select(*target.columns)
    return kept.unionByName(batch)


def upsert_sessions(snap: DataFrame, batch: DataFrame, on_duplicate: str = "error",
                    order: list[Column] | None = None) -> DataFrame:
    """Merge captured sessions by (session, statement, logon time).

    A batch with ``is_init`` (see ``capture_with_epoch_reset``) is appended as it is where the flag is true.
    """
    if "is_init" not in batch.columns:
        return upsert(snap, batch, SESSION_KEYS, on_duplicate, order)
    increment = batch.where(~F.col("is_init")).drop("is_init")
    initial = batch.where("is_init").select(*snap.columns)
    return upsert(snap, increment, SESSION_KEYS, on_duplicate, order).unionByName(initial)


def upsert_statement_stats(snap: DataFrame, batch: DataFrame, exclude_text: str | None = None, epoch=None,
                           on_duplicate: str = "error", order: list[Column] | None = None) -> DataFrame:
    """Merge statement statistics by (statement, text, instance start).

    Texts like ``exclude_text`` are left out, and with a pattern given also missing texts. When all
    of the batch belongs to one instance start, pass it as ``epoch``: rows of other starts cannot
    match and go through without a shuffle.
    """
    if exclude_text is not None:
        batch = batch.where(~F.col("sql_text").like(exclude_text))
    if epoch is None:
        return upsert(snap, batch, STATEMENT_KEYS, on_duplicate, order)
    current = F.coalesce(F.col("instance_startup_date") == moment(epoch), F.lit(False))
    return upsert(snap.where(current), batch, STATEMENT_KEYS, on_duplicate, order).unionByName(
        snap.where(~current)
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target plus the source rows whose key it lacks. NULL keys count as lacking."""
    new = source.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def insert_missing_users(dim: DataFrame, source: DataFrame, created_after, spaces: list[str]) -> DataFrame:
    """Add users created after a day whose default space fits a name or LIKE pattern; none is changed."""
    wanted = source.where(
        (F.col("created").cast("date") > F.lit(created_after)) & like_any(F.col("default_tablespace"), spaces)
    )
    return insert_missing(dim, wanted, ["user_id"])


def insert_missing_stats(snap: DataFrame, batch: DataFrame) -> DataFrame:
    """The older form: statistics are only ever added, by (statement, text) whatever the instance start."""
    return insert_missing(snap, batch, STATEMENT_KEYS_OLD)


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number. Empty means the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")


def delete_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The table without the rows that have one of the keys."""
    return df.join(keys, keys.columns, "left_anti").select(*df.columns)


def newest_of_log(log: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Read a batch log as the merged table: the newest row per key, rows with a NULL key all kept."""
    known = latest_per_key(log.where(_all_known(keys)), keys, order)
    return known.unionByName(log.where(~_all_known(keys)))
