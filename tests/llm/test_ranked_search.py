"""Ranked search against the scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opsight.llm import ranked_search

TERM = re.compile(ranked_search.TERM)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, best=10):
    cut = [(i, Counter(terms(t))) for i, t in docs]
    cut = [(i, c) for i, c in cut if c]
    n, total = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for i, c in cut:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (
                10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c)
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(13)
    vocabulary = ["".join(rnd.choice("abcdeÉé日09") for _ in range(rnd.randint(1, 5))) for _ in range(400)]

    def prose(n):
        return " ".join(rnd.choice(vocabulary[:1 + int(400 * rnd.random() ** 2)]) for _ in range(n))

    docs = [(3 * i, prose(rnd.randint(0, 150))) for i in range(150)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [(2000 + i, docs[7][1].upper()) for i in range(5)]
    docs += [(1, None), (2, ""), (4, " .,- "), (None, docs[9][1]), (None, None), (9, docs[3][1]), (9, docs[3][1]),
             (11, "w " * 5000), (13, "A-b_C\x7fd\x80é")]
    items = [(i, prose(rnd.randint(1, 40))) for i in range(25)]
    items += [(30, docs[7][1]), (31, docs[9][1][:200]), (32, None), (33, "?"), (34, "zzzz"), (None, "a b c d"), (5, "w 0"),
              (35, "A b"), (36, docs[3][1]), (37, docs[3][1] + " " + docs[7][1])]
    return docs, items


@pytest.mark.parametrize("block,pack", [(16 << 20, 1 << 20), (3000, 300)])
def test_the_best_documents(spark, table, monkeypatch, block, pack):
    docs, items = table
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block)
    monkeypatch.setattr(ranked_search, "PACK_BYTES", pack)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item_id int, id string")
    asked = spark.createDataFrame([(*i, 2, 3) for i in items], "item_id long, text string, doc_id int, score int")
    got = ranked_search.rank_documents(frame.repartition(3), asked).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(docs, items)


def test_empty_tables(spark, table):
    docs = spark.createDataFrame(table[0], "doc_id long, text string")
    items = spark.createDataFrame(table[1], "item_id long, text string")
    assert ranked_search.rank_documents(docs.where("false"), items).count() == 0
    assert ranked_search.rank_documents(docs, items.where("false")).count() == 0
    assert ranked_search.rank_documents(docs.where("doc_id = 2"), items).count() == 0


def test_quadtree_keeps_cells_and_maxima():
    rnd = np.random.default_rng(1)
    for height in (1, 3, 6):
        cells = rnd.choice(4**height, min(4**height, 200), replace=False)
        row, column, value = cells >> height, cells & (1 << height) - 1, rnd.integers(1, 1000, len(cells))
        top, quadrants, steps = ranked_search.treap(row, column, value, height)
        block = {"height": height, "top": top, "quadrants": ranked_search.zstandard.compress(quadrants.tobytes()),
                 "steps": ranked_search._pack(steps), "ids": [0], "first": ranked_search._pack(np.array([0, 1]))}
        tree = ranked_search._Tree(block)
        level = {(0, 0): 0}
        for depth in range(1, height + 1):
            below = {}
            for (r, c), node in level.items():
                at = tree.first[node]
                for q in range(4):
                    if tree.quadrants[node] >> q & 1:
                        below[2 * r + (q >> 1), 2 * c + (q & 1)] = at
                        at += 1
            level = below
            most = {}
            for r, c, v in zip(row.tolist(), column.tolist(), value.tolist()):
                at = r >> height - depth, c >> height - depth
                most[at] = max(most.get(at, 0), v)
            assert {k: int(tree.value[n]) for k, n in level.items()} == most


def test_few_ranges_are_entered(monkeypatch):
    """Bounds keep the search from most documents of a block."""
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(20000)]
    made = [" ".join(rnd.choice(vocabulary) for _ in range(120)) for _ in range(2000)]
    block = pa.RecordBatch.from_pydict({"id": pa.array(range(2000)), "text": made})
    index = ranked_search._indexed(block, 2000, 240000)
    asked = sorted(set(made[77].split()[:60]))
    some, row = ranked_search._places(index, pa.array([t.encode() for t in asked], pa.binary()))
    monkeypatch.setattr(ranked_search, "AT_ONCE", 1)
    found = ranked_search._Found(1)
    split = ranked_search._descend(ranked_search._Tree(index), [(row, np.full(len(row), 5000))], found)
    assert found.rows[0][0][2] == 77 and split < 1500
