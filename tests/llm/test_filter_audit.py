"""The filter audit against a plain simulation of every order."""

import itertools
import random
import re

import pytest

from opsight.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    marks = {}
    for i, q, t in labels:
        good, toxic = marks.get(i, (False, False))
        marks[i] = good or q == 1, toxic or t == 1
    rows = []
    for i, text, lang in docs:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if i is not None and any(j is not None and j < i and (other or "") == text for j, other, _ in docs):
            fails.add("E")
        rows.append((lang or "", fails, *(marks.get(i, (False, False)) if i is not None else (False, False))))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for k, c in enumerate(order):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(c in r[1] for r in own) - len(gone), sum(r[1] == {c} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), c]
                shapley[part, c] = shapley.get((part, c), 0) + len(gone)
    return {key: (*v[:-1], shapley[key[0], v[-1]]) for key, v in out.items()}


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(3)
    made = ["", " \t\n", "A", "word " * 250, "#", "x\x85y " * 30, " ".join(f"w{k}" for k in range(199)),
            " ".join(f"w{k}" for k in range(200)), " ".join(f"W{k}" for k in range(300)) + " $"]
    for _ in range(60):
        pool = [f"{rnd.choice('ab#CÉ日')}{k}" for k in range(rnd.randint(1, 400))]
        made.append(" ".join(rnd.choice(pool) for _ in range(rnd.randint(0, 400))))
    docs = [(i, t, rnd.choice(["en", "de", None, ""])) for i, t in enumerate(made)]
    docs += [(100 + i, rnd.choice(made), rnd.choice(["en", "fr"])) for i in range(80)]
    docs += [(None, made[3], "en"), (None, None, None), (7, made[7], "de"), (500, None, "en")]
    labels = [(rnd.choice([d[0] for d in docs]), rnd.choice([0, 1, None]), rnd.choice([0, 1])) for _ in range(120)]
    return docs, labels


def test_every_order_and_step(spark, table):
    docs, labels = table
    want = brute(docs, labels)
    frame = spark.createDataFrame([(*d, 1, "x", True) for d in docs],
                                  "doc_id long, text string, lang string, id int, digest string, A boolean").repartition(3)
    got = filter_audit.audit_filters(frame, spark.createDataFrame(
        [(*r, "t") for r in labels], "doc_id long, quality int, toxic int, text string")).collect()
    assert len(got) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == want


def test_empty_tables(spark, table):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert [r.kept for r in filter_audit.audit_filters(one, labels).where("step = 5").collect()] == [0] * 120


def test_fields_hold_the_largest_counts(spark):
    """A part of 2^16 rows that all meet in one field."""
    rows = spark.range(1 << 16).selectExpr("'p' AS part", "id < 65535 AS A", "true AS B", "CAST(NULL AS boolean) AS l")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.l_lost, r.shapley)
           for r in filter_audit.interactions(rows, "AB", ["l"]).collect()}
    assert got == {("AB", 1): (1, 65535, 0, 0, 0, 65535), ("AB", 2): (0, 1, 65535, 1, 0, 65537),
                   ("BA", 1): (0, 65536, 0, 1, 0, 65537), ("BA", 2): (0, 0, 65535, 0, 0, 65535)}
