"""Syncmer fingerprints against a plain search of every run of bytes."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opsight.llm import arrays, syncmers
from opsight.llm.syncmers import HASH_BITS, K, S, WHOLE

MASK = (1 << 64) - 1


def mix(v):
    v ^= v >> 30
    v = v * 0xBF58476D1CE4E5B9 & MASK
    v ^= v >> 27
    v = v * 0x94D049BB133111EB & MASK
    return v ^ v >> 31


def polynomial(run):
    v = 0
    for b in run:
        v = (v * 0x9E3779B97F4A7C15 + b) & MASK
    return v


def brute(raw):
    """(distance, hash) of each anchor."""
    order = [mix(polynomial(raw[i:i + S])) for i in range(len(raw) - S + 1)]
    out, last = [], 0
    for i in range(len(raw) - K + 1):
        inner = order[i:i + K - S + 1]
        if min(inner) in (inner[0], inner[-1]):
            out.append((i - last, mix(polynomial(raw[i:i + K])) >> 64 - HASH_BITS))
            last = i
    return out or [(WHOLE, zlib.crc32(raw) >> 32 - HASH_BITS)]


def alike(a, b):
    def links(f):
        return Counter((("start", *f) if k < 0 else (f[k][1], *f[k + 1])) if k >= 0 else ("start", f[0])
                       for k in range(-1, len(f) - 1))

    return 2 * sum((links(a) & links(b)).values()) / (len(a) + len(b))


def texts(rnd, n):
    made = ["", "a", "é" * 16, "x" * 200, "ab" * 60, "日本語" * 40]
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(200)]
    made += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, 120))) for _ in range(n)]
    return made + [made[8], made[9], "z" * 31, "q" * 32]


def column(values):
    return arrays.texts_of(pa.array(values, pa.string()))


def test_anchors_are_the_closed_syncmers(monkeypatch):
    made = texts(random.Random(5), 30)
    monkeypatch.setattr(syncmers, "BLOCK_BYTES", 100)  # texts over several blocks
    number, first = syncmers.anchors(column(made))
    for i, t in enumerate(made):
        got = [(int(v) >> HASH_BITS, int(v) & (1 << HASH_BITS) - 1) for v in number[first[i]:first[i + 1]]]
        assert got == brute(t.encode())
    back, again = syncmers.from_text(syncmers.to_text(number, first))
    assert np.array_equal(back, number) and np.array_equal(again, first)


def test_a_run_of_bytes_holds_an_anchor():
    rnd = random.Random(2)
    for letters in ("ab", "abcdefgh "):
        made = ["".join(rnd.choice(letters) for _ in range(rnd.randint(2 * K - S - 1, 900))) for _ in range(60)]
        number, first = syncmers.anchors(column(made))
        assert (number >> HASH_BITS).max() <= K - S


def want(docs):
    """The results of the query by id, from its definition."""
    rows = sorted((i, t or "") for i, t in docs if i is not None)
    out = Counter()
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        f, g, h = (brute(x.encode()) for x in (t, edited, after))
        out[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(alike(f, g), 9), round(alike(f, h), 9)] += 1
    for t in [t or "" for i, t in docs if i is None]:
        edited = t[:len(t) - len(t) // 2]
        f, g, h = (brute(x.encode()) for x in (t, edited, ""))
        out[None, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(alike(f, g), 9), round(alike(f, h), 9)] += 1
    return out


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_edited_fingerprints(spark, monkeypatch, block):
    rnd = random.Random(9)
    made = texts(rnd, 50)
    rnd.shuffle(made)
    docs = [(7 * i + (3 << 60), t) for i, t in enumerate(made)]
    docs += [(5, None), (5, "twice"), (5, "twice"), (-4, made[0]), (None, "no id é"), (None, None), (None, made[1])]
    frame = spark.createDataFrame([(*d, 1, "g", 2.0) for d in docs],
                                  "doc_id long, text string, bucket int, guest string, least double").repartition(3)
    monkeypatch.setattr(syncmers, "BLOCK_BYTES", block)
    got = syncmers.edited_fingerprints(frame).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == want(docs)
    prints = {}
    for r in got:
        for t in {t or "" for i, t in docs if i == r.doc_id}:
            prints.setdefault(t, set()).add(r.fingerprint) if sum(i == r.doc_id for i, _ in docs) == 1 else None
    assert all(len(p) == 1 for p in prints.values())


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(3, "word " * 60)], "doc_id long, text string")
    r = syncmers.edited_fingerprints(one).collect()
    assert [(x.doc_id, x.near_next) for x in r] == [(3, 1.0)]
    assert syncmers.edited_fingerprints(one.where("false")).count() == 0


def test_tables_of_fingerprints_and_pairs(spark):
    made = texts(random.Random(4), 10)
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in syncmers.fingerprints(docs).collect()}
    number, first = syncmers.anchors(column(made))
    assert [got[i] for i in range(len(made))] == syncmers.to_text(number, first).to_pylist()
    rows = [(got[8], got[8], 1), (got[8], got[3], 2), (None, got[3], 3), (None, None, 4)]
    pairs = spark.createDataFrame(rows, "a string, b string, k int")
    like = {r.k: r.likeness for r in syncmers.with_likeness(pairs, "a", "b").collect()}
    assert like[1] == 1 and like[3] == 0 and like[4] == 1 and 0 <= like[2] < 0.2
