"""Benchmark passages in documents, up to edits of words: CGK embedding, bit-sampling LSH, exact check."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays

#: Bytes of text handled together; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: A window is a copy if at most this share of the item's words is inserted, deleted or replaced.
EDITS = 0.2
#: LSH: hash tables, each with its own walk, and embedded words sampled for each table's key. The longer the item the
#: farther apart the edits drive two walks, so items over ``SHORT`` words have one sample a key and, from 320 words on,
#: a table for ten words. Of simulated copies at the limit 99 in 100 or more are found at every length.
TABLES, SAMPLES, SHORT, WORDS_A_TABLE = 32, 2, 60, 10
#: Benchmark items whose words fill one block of the search; further items are searched in further blocks.
ITEM_BLOCK_WORDS = 1 << 20
#: Windows embedded together.
_WINDOWS = 1 << 14


class Items(NamedTuple):
    """A block of benchmark items, ready to be searched for."""

    ids: list[int]
    words: list[np.ndarray]
    vocabulary: np.ndarray  # hashes of all their words, sorted
    pairs: np.ndarray  # and of all their word pairs
    keys: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: the items and their keys, a column per table


def word_hashes(texts: arrays.Texts) -> tuple[np.ndarray, arrays.Runs]:
    """Hashes of the words (runs of letters and digits, A-Z lowered)."""
    texts = texts._replace(data=arrays.LOWER[texts.data])
    spans = arrays.runs(texts, arrays.WORD_CHARACTER[texts.data])
    return arrays.run_hashes(texts.data, spans), spans


def _steps(length: int) -> int:
    """How far walks go: at half a word a step, two steps a word reach the end of the item."""
    return 2 * length


def tables(length: int) -> int:
    """How many tables items of a length are searched by."""
    return max(TABLES, -(-length // WORDS_A_TABLE))


def sampled_steps(length: int) -> np.ndarray:
    """The steps whose words make each table's key."""
    samples = SAMPLES if length <= SHORT else 1
    return np.random.default_rng(length).integers(0, _steps(length), (tables(length), samples))


def keys(hashes: np.ndarray, windows: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The LSH keys, a column per table, of the windows of ``length: first words``.

    CGK: a walk writes the word it stands on at each step and then moves on or stays, by a random bit that
    depends on the step and the word alone. Two sequences of small edit distance fall into step again
    soon after each edit, so they differ in few of the words written. Behind its end a window writes blanks.
    Windows that begin at one word share the walk.
    """
    found = {m: np.zeros((len(some), tables(m)), np.uint64) for m, some in windows.items()}
    samples = {m: sampled_steps(m) for m in windows}
    last, walked = len(hashes) - 1, None
    for t in range(max(map(tables, windows), default=0)):
        here_too = [m for m in windows if t < tables(m)]
        if here_too != walked:
            walked = here_too
            starts = np.unique(np.concatenate([windows[m] for m in walked]))
            place = {m: np.searchsorted(starts, windows[m]) for m in walked}
            far = _steps(max(walked))
        odd = np.random.default_rng(t).integers(0, 1 << 64, far, np.uint64, endpoint=False) | np.uint64(1)
        at = np.zeros((far, len(starts)), np.int16 if far < 1 << 15 else np.int64)
        for step in range(far - 1):
            word = hashes[np.minimum(starts + at[step], last)]
            at[step + 1] = at[step] + ((word * odd[step]) >> np.uint64(63)).astype(at.dtype)
        for m in walked:
            some = windows[m]
            for step in samples[m][t].tolist():
                here = at[step, place[m]]
                word = np.where(here < m, hashes[np.minimum(some + here, last)], np.uint64(0))
                found[m][:, t] = arrays.mix(found[m][:, t] * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(1))
    return found


def pair_hashes(hashes: np.ndarray) -> np.ndarray:
    return arrays.mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])


def prepare(items: list[tuple[int, str]]) -> Items:
    """Items without a word are left out: nothing can be a copy of them."""
    texts = arrays.texts_of(pa.array([t for _, t in items], pa.string()))
    hashes, spans = word_hashes(texts)
    words = [hashes[a:b] for a, b in zip(spans.first[:-1], spans.first[1:])]
    kept = [i for i, w in enumerate(words) if len(w)]
    ids, words = [items[i][0] for i in kept], [words[i] for i in kept]
    by_length = defaultdict(list)
    for i, w in enumerate(words):
        by_length[len(w)].append(i)
    begin = spans.first[:-1][kept]
    found = keys(hashes, {m: begin[members] for m, members in by_length.items()}) if kept else {}
    none = np.zeros(0, np.uint64)
    return Items(ids, words, np.unique(np.concatenate([none, *words])),
                 np.unique(np.concatenate([none, *map(pair_hashes, words)])),
                 {m: (np.array(members), found[m]) for m, members in by_length.items()})


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    """Levenshtein distance over words, bit-parallel over the words of ``a``."""
    m = len(a)
    if not m:
        return len(b)
    where = defaultdict(int)
    for i, word in enumerate(a.tolist()):
        where[word] |= 1 << i
    full, last = (1 << m) - 1, 1 << m - 1
    up, down, distance = full, 0, m
    for word in b.tolist():
        same = where.get(word, 0)
        x = (((same & up) + up) ^ up) | same | down
        rise = down | ~(x | up) & full
        fall = up & x
        distance += bool(rise & last) - bool(fall & last)
        rise = rise << 1 | 1
        up = (fall << 1 | ~(x | rise)) & full
        down = rise & x & full
    return distance


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Marks the values that are in the sorted ``known``; most are told apart by their low bits."""
    low = np.uint64((1 << 22) - 1)
    there = np.zeros(1 << 22, bool)
    there[(known & low).astype(np.int64)] = True
    marked = there[(values & low).astype(np.int64)]
    maybe = np.flatnonzero(marked)
    if len(known):
        at = np.minimum(np.searchsorted(known, values[maybe]), len(known) - 1)
        marked[maybe] = known[at] == values[maybe]
    return marked


def windows_to_embed(hashes: np.ndarray, first: np.ndarray, items: Items) -> dict[int, np.ndarray]:
    """By length the first words of the item-sized windows that can be within the edits of any item.

    An edit touches one word and at most two word pairs of an item, so a copy within e edits of m words still
    holds m - e words and m - 1 - 2e pairs of items; a window with fewer needs no embedding. Nothing
    that could match is lost.
    """
    if not items.keys:
        return {}
    pairs = pair_hashes(hashes) if len(hashes) > 1 else np.zeros(0, np.uint64)
    pair = np.zeros(len(hashes) + 1, np.int32)
    np.cumsum(_among(pairs, items.pairs), out=pair[1:len(pairs) + 1])
    pair[len(pairs) + 1:] = pair[len(pairs)]
    word = np.zeros(len(hashes) + 1, np.int32)
    np.cumsum(_among(hashes, items.vocabulary), out=word[1:])
    end = np.repeat(first[1:], np.diff(first))
    edits = {m: int(EDITS * m) for m in items.keys}
    # places from which the longest window holds the fewest pairs that any length asks for
    reach, least = max(edits), min(m - 1 - 2 * e for m, e in edits.items())
    place = np.arange(len(hashes))
    if least > 0:
        place = np.flatnonzero(pair[np.minimum(place + reach, len(hashes))] - pair[:-1] >= least)
    found = {}
    for m, e in edits.items():
        some = place[place + m <= end[place]]
        some = some[pair[some + m - 1] - pair[some] >= m - 1 - 2 * e]
        some = some[word[some + m] - word[some] >= m - e]
        if len(some):
            found[m] = some
    return found


def matches(hashes: np.ndarray, first: np.ndarray, items: Items) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(text, item) to the (distance, first word, words) of its closest window, the first of equals."""
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    whole = windows_to_embed(hashes, first, items)
    starts = np.unique(np.concatenate(list(whole.values()))) if whole else np.zeros(0, np.int64)
    for begin in range(0, len(starts), _WINDOWS):
        low, high = starts[begin], starts[min(begin + _WINDOWS, len(starts)) - 1]
        windows = {m: some[(some >= low) & (some <= high)] for m, some in whole.items()}
        found = keys(hashes, windows)
        for m, some in windows.items():
            members, wanted = items.keys[m]
            for i, key in zip(members.tolist(), wanted):
                near = some[(found[m] == key).any(axis=1)]
                if not len(near):
                    continue
                words = hashes[near[:, None] + np.arange(m)]
                known = np.sort(items.words[i])
                same = known[np.minimum(np.searchsorted(known, words), m - 1)] == words
                if m > 1:
                    known = np.sort(pair_hashes(items.words[i]))
                    pairs = pair_hashes(words.T).T  # of the words beside each other in each window
                    held = (known[np.minimum(np.searchsorted(known, pairs), m - 2)] == pairs).sum(axis=1)
                    held = held >= m - 1 - 2 * int(EDITS * m)
                    near, same = near[held], same[held]
                lacking = m - same.sum(axis=1)  # the distance is this or more
                order = np.lexsort((near, lacking))
                order = order[lacking[order] <= int(EDITS * m)]
                near, lacking = near[order], lacking[order]
                text = np.searchsorted(first, near, "right") - 1
                for n, (where, at) in enumerate(zip(text.tolist(), near.tolist())):
                    now = best.get((where, i), (int(EDITS * m), len(hashes), m))
                    if (int(lacking[n]), at) < now[:2]:
                        distance = edit_distance(items.words[i], hashes[at:at + m])
                        now = min(now, (distance, at, m))
                        if now[1] < len(hashes):
                            best[where, i] = now
                        # a window that begins k words off is at most 2 k edits closer
                        least = np.where(text[n + 1:] == where, distance - 2 * np.abs(near[n + 1:] - at), 0)
                        np.maximum(lacking[n + 1:], least, out=lacking[n + 1:])
    return best


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[Items]:
    """The items in blocks of bounded size, whatever their number."""
    some, size = [], 0
    for row in benchmark.where(F.col(item_col).isNotNull()).select(
            F.col(item_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))).toLocalIterator():
        some.append((row[0], row[1]))
        size += row[1].count(" ") + 1
        if size >= ITEM_BLOCK_WORDS:
            yield prepare(some)
            some, size = [], 0
    if some:
        yield prepare(some)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The benchmark items that documents hold: ``id_col``, ``item_col``, distance, n_words, start, end.

    One row per document row and item with a window of as many words as the item within 20 % edits (over words
    in lower case without punctuation): the closest one, the first of equals; start and end are bytes.
    Windows stand at every word of the whole text. Their embedding is sampled into tables, more for longer items, so
    that a window at the limit is missed with a chance of about one in a hundred at most, measured on simulated edits of
    items of 10 to 1,000 words, and every candidate is checked exactly. The
    items are a query set: they are sent to the executors in blocks of bounded size, and each block
    is searched in all documents. Null and empty texts and items match nothing; items with a null id are
    not looked for; repeated documents and items give rows each; an empty table gives none; other columns
    are not looked at.
    """
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    schema = "id long, item long, distance int, n_words int, start long, end long"

    def search(shared):
        def run(batches):
            items = shared.value
            for block in arrays.blocks(batches, BLOCK_BYTES):
                texts = arrays.texts_of(block.column("text"))
                hashes, spans = word_hashes(texts)
                rows = [(t, items.ids[i], *m) for (t, i), m in sorted(matches(hashes, spans.first, items).items())]
                t, item, distance, word, m = (np.array(x, np.int64) for x in zip(*rows)) if rows else [
                    np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_pydict({
                    "id": block.column("id").take(pa.array(t)), "item": pa.array(item),
                    "distance": pa.array(distance.astype(np.int32)), "n_words": pa.array(m.astype(np.int32)),
                    "start": pa.array(spans.start[word] - texts.offsets[t]),
                    "end": pa.array(spans.end[word + m - 1] - texts.offsets[t]),
                })

        return run

    found = docs.sparkSession.createDataFrame([], schema)
    for items in _item_blocks(benchmark, item_col, item_text_col):
        found = found.unionByName(flat.mapInArrow(search(context.broadcast(items)), schema))
    return found.withColumnsRenamed({"id": id_col, "item": item_col})


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, without the rows that hold a benchmark item as ``contaminated`` finds it."""
    context = docs.sparkSession.sparkContext

    def clean(shared):
        def change(texts):
            hashes, spans = word_hashes(texts)
            keep = np.ones(len(texts.offsets) - 1, bool)
            keep[[t for t, _ in matches(hashes, spans.first, shared.value)]] = False
            return keep, None

        return change

    for items in _item_blocks(benchmark, item_col, item_text_col):
        docs = arrays.change_rows(docs, text_col, BLOCK_BYTES, clean(context.broadcast(items)))
    return docs
