"""What each of several filters adds to the others, in every order in which they could be applied.

A row matters only by the set of filters it fails and the labels it has. Such a mask is mapped to one wide integer that
holds, in fields of its own, what happens to the row at every step of every order; the integers of a part are
summed, and one unpacking gives all counts of the part.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.session import scratch_path

#: The limits of the filters: words, percent of distinct words, percent of capitals, symbols.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 200, 50, 3, "[#$%&*|]"
#: Runs of ASCII white space, which separate words.
SPACES = r"[\x20\x09-\x0D]+"
#: The fields of a step, before those of the labels.
COUNTS = ("kept", "removed", "redundant", "unique_fails")


@functools.cache
def _steps(filters: str) -> list[tuple[str, int, str]]:
    """Every (order, step, its filter), orders as the letters' order has them."""
    return [("".join(o), k + 1, o[k]) for o in itertools.permutations(filters) for k in range(len(filters))]


@functools.cache
def _wide(filters: str, fails: int, labels: tuple[bool, ...], width: int) -> int:
    """The integer of a mask: for each step its fields of ``width`` bytes, each 0 or 1."""
    failed = {c for k, c in enumerate(filters) if fails >> k & 1}
    fields = []
    for order, step, letter in _steps(filters):
        before, here = bool(failed & set(order[:step - 1])), letter in failed
        removed = here and not before
        fields += [not before and not here, removed, here and before, failed == {letter}]
        fields += [removed and label for label in labels]
    spread = np.zeros((len(fields), width), np.uint8)
    spread[:, 0] = fields
    return int.from_bytes(spread.tobytes(), "little")


def _unpacked(total: int, fields: int, width: int) -> np.ndarray:
    spread = np.zeros((fields, 8), np.uint8)
    spread[:, :width] = np.frombuffer(total.to_bytes(fields * width, "little"), np.uint8).reshape(fields, width)
    return spread.view("<u8").ravel().astype(np.int64)


def interactions(rows: DataFrame, filters: str, labels: Sequence[str] = (), part_col: str = "part") -> DataFrame:
    """For each value of ``part_col``, order of the ``filters`` and step: kept, removed, redundant and unique_fails,
    ``<label>_lost`` for each label, and shapley, what the step's filter removes in all orders together.

    ``rows`` has a boolean column per letter of ``filters`` (true: the row fails it) and per label. A null one counts
    as false. Rows are counted by part and mask before anything moves, so that a part of any size is at
    most 2^(filters + labels) integers when they are summed. A field has the bytes that the number of rows in
    its part needs, which no count exceeds, so none runs over into the next. Rows of a null part are a part; an
    empty table gives no rows. One order more is a factor of the number of filters: keep it at 7 or below.
    """
    of = [F.coalesce(F.col(c), F.lit(False)) for c in [*filters, *labels]]
    mask = functools.reduce(lambda a, b: a + b, [c.cast("int") * (1 << k) for k, c in enumerate(of)])
    tally = rows.select(F.col(part_col).alias("part"), mask.alias("mask")).groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"))
    names = [*COUNTS, *(f"{c}_lost" for c in labels)]

    def sums(table: pa.Table) -> pa.Table:
        masks, counts = table.column("mask").to_pylist(), table.column("n").to_pylist()
        width = (sum(counts).bit_length() + 7) // 8
        steps, total = _steps(filters), 0
        for m, n in zip(masks, counts):
            marks = tuple(bool(m >> len(filters) + k & 1) for k in range(len(labels)))
            total += n * _wide(filters, m & (1 << len(filters)) - 1, marks, width)
        found = _unpacked(total, len(steps) * len(names), width).reshape(len(steps), len(names))
        letter = np.array([s[2] for s in steps])
        shapley = sum(np.where(letter == c, found[letter == c, 1].sum(), 0) for c in filters)
        columns = {"part": pa.array([table.column("part")[0].as_py()] * len(steps), pa.string()),
                   "filter_order": pa.array([s[0] for s in steps]), "step": pa.array([s[1] for s in steps], pa.int32())}
        columns |= {n: pa.array(found[:, k]) for k, n in enumerate(names)}
        return pa.table(columns | {"shapley": pa.array(shapley)})

    kinds = ", ".join(f"{n} long" for n in names)
    return tally.groupBy("part").applyInArrow(sums, f"part string, filter_order string, step int, {kinds}, shapley long")


def _numbered(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    read = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                       text.alias("text"), words.alias("words"))
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return read.select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
        (F.size("words") < LEAST_WORDS).alias("A"),
        (100 * F.size(F.array_distinct("words")).cast("long") < LEAST_DISTINCT * F.size("words").cast("long")).alias("B"),
        (100 * capitals.cast("long") > MOST_CAPITALS * F.length("text").cast("long")).alias("C"),
        F.col("text").rlike(SYMBOLS).alias("D"))


def audit_filters(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "lang") -> DataFrame:
    """The five filters A to E over ``docs``, by language and in all 120 orders; see ``interactions``.

    A null text is empty and a null language the empty string. A text is a copy (E) if a row of a smaller id has the
    same SHA-256; a row without id is no copy and makes none, and has no labels. Repeated rows count each, and
    rows of one id are no copies of each other. If an id has several labels, any 1 counts. Other columns, and those of
    the same name in ``labels``, are not looked at.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "filter-masks")
    _numbered(docs, id_col, text_col, part_col).write.parquet(path)
    rows = spark.read.parquet(path)
    # only texts that occur again; their rows need the smallest id
    first = rows.groupBy("digest").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    marks = labels.select(F.col(id_col).cast("long").alias("id"), (F.col("quality") == 1).alias("good"),
                          (F.col("toxic") == 1).alias("toxic")).where("id IS NOT NULL").groupBy("id").agg(
        F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = rows.join(first.select("digest", "least"), "digest", "left").withColumn("E", F.col("id") > F.col("least"))
    return interactions(rows.join(marks, "id", "left"), "ABCDE", ("good", "toxic"))


#: The same counts in SQL, by a join of masks and steps.
AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS least FROM texts),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n,
    (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END)
    || (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM cut LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || x.c || y.c || z.c AS filter_order
  FROM letters a JOIN letters b ON b.c <> a.c JOIN letters x ON x.c NOT IN (a.c, b.c)
  JOIN letters y ON y.c NOT IN (a.c, b.c, x.c) JOIN letters z ON z.c NOT IN (a.c, b.c, x.c, y.c)),
steps AS (
  SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
  SELECT part, filter_order, step::INTEGER AS step, any_value(letter) AS letter,
    sum(n) FILTER (passed AND NOT here) AS kept, sum(n) FILTER (passed AND here) AS removed,
    sum(n) FILTER (here AND NOT passed) AS redundant, sum(n) FILTER (fails = letter) AS unique_fails,
    sum(n) FILTER (passed AND here AND good) AS good_lost, sum(n) FILTER (passed AND here AND toxic) AS toxic_lost
  FROM (SELECT *, translate(fails, before, '') = fails AS passed, contains(fails, letter) AS here FROM masks, steps)
  GROUP BY part, filter_order, step)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM counted
"""
