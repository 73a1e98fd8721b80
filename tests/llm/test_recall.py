"""How many copies at the limit of the edits the walks of the decontamination find, by the items' length."""

import numpy as np
import pytest

from opsight.llm import decontamination


def edited(item, replace, rng):
    """A copy with as many edits as are allowed: words replaced, or half as many removed as added elsewhere."""
    words, edits = item.tolist(), int(decontamination.EDITS * len(item))
    new = rng.integers(1 << 40, 1 << 62, edits).tolist()
    if replace:
        for at in rng.choice(len(words), edits, replace=False):
            words[at] = new.pop()
        return words
    for _ in range(edits // 2):
        del words[rng.integers(len(words))]
    for _ in range(edits // 2):
        words.insert(rng.integers(len(words) + 1), new.pop())
    return words


@pytest.mark.parametrize("replace", [True, False])
@pytest.mark.parametrize("length", [10, 20, 30, 60, 61, 120, 256, 400, 500, 1000])
def test_copies_at_the_limit_are_found(length, replace):
    rng = np.random.default_rng([length, replace])
    trials = 300 if length <= 500 else 200
    items = [rng.integers(1, 1 << 40, length) for _ in range(trials)]
    copies = [edited(i, replace, rng) for i in items]
    where = {length: np.arange(trials) * length}
    a, b = (decontamination.keys(np.concatenate(x).astype(np.uint64), where)[length] for x in (items, copies))
    assert (a == b).any(axis=1).mean() >= 0.99
    assert edits_allowed(items, copies)


def edits_allowed(items, copies):
    return all(decontamination.edit_distance(np.array(i), np.array(c)) <= int(decontamination.EDITS * len(i))
               for i, c in zip(items[:20], copies[:20]))
