"""A corpus as bounded batches of whole documents: the distinct words of each batch, and how often each
document has them.

A value that belongs to a word over the whole corpus (its count, its length in pieces) is found by word in
one shuffle, sent back to the word's places (batch and code), and summed per document there. A key has at most one row
per batch, so no word, however common, makes a large group, and what is shuffled grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays
from opsight.session import scratch_path

#: Bytes of text in a batch; a longer document is a batch of its own. Words are cut from smaller blocks.
BATCH_BYTES, BLOCK_BYTES = 32 << 20, 4 << 20

#: Places that a task sends back at a time.
DEAL_PLACES = 1 << 20

#: A word's place is its batch and, in so many bits, its code there.
CODE_BITS = 26
_SCHEMA = ("batch long, word binary, place long, marked long, ids array<bigint>, n_bytes array<bigint>, "
           "flags array<boolean>, tags array<bigint>, first binary, codes binary, counts binary")


def write_batches(docs: DataFrame, split: Callable[[arrays.Texts], tuple[np.ndarray, arrays.Runs]],
                  name: str) -> tuple[DataFrame, DataFrame]:
    """Cut the texts of ``docs`` (id, text, flag, tag) into words; returns ``batches`` and ``words``.

    ``split`` gives the bytes to use and the words in them. ``words`` has a row per distinct word: word, marked
    (occurrences in flagged documents) and its places, one per batch at most; ``batches`` has for each batch its documents and
    their (code, count) pairs. Both are read from one table in the shared folder, so the texts are cut once
    and a lost executor costs no second cut.
    """

    def cut(batches):
        from pyspark import TaskContext

        base, at = TaskContext.get().partitionId() << 16, 0
        for whole in arrays.blocks(batches, BATCH_BYTES):
            parts, firsts, sizes = [], [], []
            for block in arrays.blocks([whole], BLOCK_BYTES):
                texts = arrays.texts_of(block.column("text"))
                data, spans = split(texts)
                parts.append(arrays.pieces_array(data, spans).cast(pa.binary()))
                firsts.append(spans.first)
                sizes.append(np.diff(texts.offsets))
            # one dictionary over all blocks
            coded = pa.chunked_array(parts, pa.binary()).dictionary_encode()
            parts.clear()
            dictionary = coded.chunk(coded.num_chunks - 1).dictionary if coded.num_chunks else pa.array([], pa.binary())
            known, row = len(dictionary), 0
            flag = whole.column("flag").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            marked, total = np.zeros(known, np.int64), np.zeros(known, np.int64)
            lengths, steps, counts = [np.zeros(1, np.int64)], [], []
            for first, chunk in zip(firsts, coded.chunks):
                code = chunk.indices.to_numpy(zero_copy_only=False)
                n = len(first) - 1
                text = np.repeat(np.arange(n), np.diff(first))
                total += np.bincount(code, minlength=known)
                marked += np.bincount(code[flag[row:row + n][text]], minlength=known)
                pair, count = np.unique(text * known + code, return_counts=True)
                owner, step = np.divmod(pair, max(known, 1))
                step[1:] -= np.where(owner[1:] == owner[:-1], step[:-1], 0)
                lengths.append(np.bincount(owner, minlength=n))
                steps.append(step.astype(np.uint32))
                counts.append(count.astype(np.uint32))
                row += n
            batch = base + at
            at += 1
            # in the order of the words, which the shuffle and the files compress better
            order = pc.sort_indices(dictionary).to_numpy().astype(np.int64)
            for begin in range(0, known, 1 << 16):
                some = order[begin:begin + (1 << 16)]
                yield _row(batch, len(some), word=dictionary.take(pa.array(some)),
                           place=pa.array((batch << CODE_BITS) + some), marked=pa.array(marked[some]))
            yield _row(
                batch, 1, ids=pa.array([whole.column("id").to_pylist()], pa.list_(pa.int64())),
                n_bytes=pa.array([np.concatenate(sizes)], pa.list_(pa.int64())),
                flags=pa.array([flag], pa.list_(pa.bool_())),
                tags=pa.array([whole.column("tag").to_pylist()], pa.list_(pa.int64())),
                first=pa.array([np.cumsum(np.concatenate(lengths)).astype(np.uint32).tobytes()]),
                codes=pa.array([_packed(steps)]), counts=pa.array([_packed(counts)]),
            )
            del coded, dictionary, steps, counts, marked
            pa.default_memory_pool().release_unused()

    path = scratch_path(docs.sparkSession, name)
    docs.mapInArrow(cut, _SCHEMA).write.option("compression", "zstd").parquet(path)
    read = docs.sparkSession.read.parquet
    batches = read(path).where("first IS NOT NULL").drop("word", "place", "marked")
    # a word has a row per batch at most, so nothing is gained by grouping before the shuffle
    words = read(path).where("word IS NOT NULL").select("word", "place", "marked").repartition("word").groupBy("word").agg(
        F.sum("marked").alias("marked"), F.collect_list("place").alias("places"))
    return batches, words


_TYPES = {
    "word": pa.binary(), "place": pa.int64(), "marked": pa.int64(), "ids": pa.list_(pa.int64()),
    "n_bytes": pa.list_(pa.int64()), "flags": pa.list_(pa.bool_()), "tags": pa.list_(pa.int64()), "first": pa.binary(), "codes": pa.binary(),
    "counts": pa.binary(),
}


def _packed(parts: list[np.ndarray]) -> bytes:
    """Numbers by byte: all lowest bytes first, as the others are mostly zero."""
    flat = np.concatenate([np.zeros(0, np.uint32), *parts])
    return zstandard.compress(flat.view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel()


def _dealt(values: DataFrame) -> DataFrame:
    """``values`` (places, value) by batch: of what a task has at a time, each batch's codes in order, as the
    steps between them, and their values. Low and high bytes are apart, as the high ones are mostly zero."""

    def deal(batches):
        waiting, n = [], 0
        for rows in batches:
            places = rows.column("places")
            at = places.flatten().to_numpy()
            waiting.append((at, np.repeat(rows.column("value").to_numpy(), pc.list_value_length(places).to_numpy())))
            n += len(at)
            if n >= DEAL_PLACES:
                yield from _by_batch(waiting)
                waiting, n = [], 0
        yield from _by_batch(waiting)

    return values.select("places", "value").mapInArrow(
        deal, "batch long, step_low binary, step_high binary, value_low binary, value_high binary")


def _by_batch(waiting: list[tuple[np.ndarray, np.ndarray]]):
    places, values = (np.concatenate([np.zeros(0, np.int64), *parts]) for parts in (zip(*waiting) if waiting else ((), ())))
    for begin in range(0, len(places), DEAL_PLACES):
        place, value = places[begin:begin + DEAL_PLACES], values[begin:begin + DEAL_PLACES]
        order = np.argsort(place)
        place, value = place[order], value[order]
        batch, step = place >> CODE_BITS, place & ((1 << CODE_BITS) - 1)
        same = batch[1:] == batch[:-1]
        step[1:] -= np.where(same, step[:-1], 0)
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])
        bounds = np.append(first, len(place))

        def plane(part: np.ndarray) -> pa.Array:
            offsets = (bounds * part.shape[1]).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(part.tobytes())])

        steps = step.astype("<u4").view(np.uint8).reshape(-1, 4)
        amounts = value.astype("<i8").view(np.uint8).reshape(-1, 8)
        yield pa.RecordBatch.from_pydict({
            "batch": pa.array(batch[first]), "step_low": plane(steps[:, :1]), "step_high": plane(steps[:, 1:]),
            "value_low": plane(amounts[:, :1]), "value_high": plane(amounts[:, 1:]),
        })


def _undealt(found: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Codes and values of the rows that ``_dealt`` made for one batch."""

    def numbers(name: str, kind: str) -> np.ndarray:
        width = np.dtype(kind).itemsize
        low, high = (b"".join(found.column(f"{name}_{part}").to_pylist()) for part in ("low", "high"))
        out = np.empty((len(low), width), np.uint8)
        out[:, 0] = np.frombuffer(low, np.uint8)
        out[:, 1:] = np.frombuffer(high, np.uint8).reshape(-1, width - 1)
        return out.view(kind).ravel().astype(np.int64)

    step, value = numbers("step", "<u4"), numbers("value", "<i8")
    length = np.array([len(b) for b in found.column("step_low").to_pylist()], np.int64)
    code = np.cumsum(step)
    first = np.cumsum(length) - length
    return code - np.repeat(code[first] - step[first], length), value


def _row(batch: int, rows: int, **columns: pa.Array) -> pa.RecordBatch:
    made = {"batch": pa.array(np.full(rows, batch, np.int64))}
    made |= {n: columns[n] if n in columns else pa.nulls(rows, kind) for n, kind in _TYPES.items()}
    return pa.RecordBatch.from_pydict(made)


def sum_per_document(batches: DataFrame, values: DataFrame, sums: dict[str, Callable[[np.ndarray], np.ndarray]],
                     kinds: dict[str, str]) -> DataFrame:
    """One row per document: id, flag, tag, n_bytes, n_words, and sums over its words, repeats counted.

    ``values`` has (places, value), a row for every word; ``sums`` gives for each result what a word adds to
    it, from the words' values, and ``kinds`` its type, ``long`` or ``double``.
    """
    def add(batch: pa.Table, found: pa.Table) -> pa.Table:
        code, amount = _undealt(found)
        value = np.zeros(int(code.max()) + 1 if len(code) else 0, np.int64)
        value[code] = amount
        out = {n: [] for n in ("id", "flag", "tag", "n_bytes")}
        totals = {n: [np.zeros(0, np.int64)] for n in ("n_words", *sums)}
        for b in batch.to_pylist():
            first = np.frombuffer(b["first"], np.uint32).astype(np.int64)
            count = _unpacked(b["counts"])
            run = np.concatenate([[0], np.cumsum(_unpacked(b["codes"]), dtype=np.int64)])
            place = run[1:] - np.repeat(run[first[:-1]], np.diff(first))
            for n, part in {"n_words": np.ones_like(value), **{n: f(value) for n, f in sums.items()}}.items():
                part = np.concatenate([[0], np.cumsum(part[place] * count, dtype=part.dtype)])
                totals[n].append(part[first[1:]] - part[first[:-1]])
            for n, c in (("id", "ids"), ("flag", "flags"), ("tag", "tags"), ("n_bytes", "n_bytes")):
                out[n] += b[c]
        columns = {n: pa.array(v, pa.bool_() if n == "flag" else pa.int64()) for n, v in out.items()}
        for n, parts in totals.items():
            kind = pa.float64() if kinds.get(n) == "double" else pa.int64()
            columns[n] = pa.array(np.concatenate(parts)).cast(kind)
        pa.default_memory_pool().release_unused()
        return pa.table(columns)

    schema = "id bigint, flag boolean, tag bigint, n_bytes bigint, n_words bigint" + "".join(
        f", {n} {kinds[n]}" for n in sums)
    return batches.groupBy("batch").cogroup(_dealt(values).groupBy("batch")).applyInArrow(add, schema)
