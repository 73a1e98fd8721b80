"""The fit against plain FTRL-proximal, one coordinate at a time."""

import math
import random
import tracemalloc

import numpy as np

from opsight.llm import toxicity as t


def plain(examples, labels):
    z, n = {}, {}

    def weight(f):
        pull, grip = z.get(f, 0.0), 0.0 if f == "bias" else t.L1
        if abs(pull) <= grip:
            return 0.0
        return -(pull - math.copysign(grip, pull)) / ((t.BETA + math.sqrt(n[f])) / t.ALPHA + t.L2)

    for _ in range(t.EPOCHS):
        for example, label in zip(examples, labels):
            used = [*example, "bias"]
            now = {f: weight(f) for f in used}
            gradient = 1 / (1 + math.exp(-sum(now.values()))) - label
            for f in used:
                seen = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + gradient - (math.sqrt(seen + gradient ** 2) - math.sqrt(seen)) / t.ALPHA * now[f]
                n[f] = seen + gradient ** 2
    return {f: weight(f) for f in z if weight(f)}


def test_the_fit_equals_plain_ftrl_and_keeps_rare_features():
    rng = random.Random(5)
    rare = (1 << t.BITS) - 1
    examples = [sorted(rng.sample(range(1 << t.BITS), 5) + rng.sample(range(40), 12)) for _ in range(400)]
    labels = np.array([float(sum(f < 8 for f in e) > 3) for e in examples])
    for i in np.flatnonzero(labels == 1)[:3]:
        examples[i].append(rare)
    feature, weight, bias = t.fit([np.array(e, "<u4") for e in examples], labels)
    want = plain(examples, labels)
    assert abs(bias - want.pop("bias")) < 1e-9
    got = dict(zip(feature.tolist(), weight.tolist()))
    assert got.keys() == want.keys() and all(abs(got[f] - w) < 1e-9 for f, w in want.items())
    assert got[rare] > 0  # three examples are enough
    assert t.fit([], np.zeros(0))[2] == 0.0


def test_features_of_one_example_take_little_room_and_get_their_weights():
    rng = random.Random(6)
    examples = [sorted({*rng.sample(range(40, 1 << t.BITS), 30), *rng.sample(range(40), 12)}) for _ in range(60)]
    labels = np.array([float(i in (7, 41)) for i in range(60)])  # nothing but their own features tells these two
    feature, weight, bias = t.fit([np.array(e, "<u4") for e in examples], labels)
    want = plain(examples, labels)
    want.pop("bias")
    got = dict(zip(feature.tolist(), weight.tolist()))
    assert got.keys() == want.keys() and all(abs(got[f] - w) < 1e-9 for f, w in want.items())
    assert sum(f in got for f in examples[7]) >= 30 and np.all(np.diff(feature) > 0)

    lone = np.random.default_rng(7).permutation(1 << 21).astype("<u4") * np.uint32(1 << t.BITS - 21)
    telling = [np.arange(1, 21, dtype="<u4"), np.arange(21, 41, dtype="<u4")]
    examples = [np.sort(np.concatenate([telling[i % 2], part])) for i, part in enumerate(np.split(lone, 1 << 9))]
    tracemalloc.start()
    t.fit(examples, np.arange(1 << 9) % 2.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * len(lone)
