"""Texts of an Arrow batch as flat byte arrays: words, lines and their hashes without a loop over words.

Everything here runs inside one task on one bounded block of whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The white space of the word rule: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII letters and digits and every byte of a longer character.
WORD_CHARACTER = np.zeros(256, bool)
WORD_CHARACTER[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1),
                *range(0x80, 0x100)]] = True
#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_BYTE = np.random.default_rng(20240229).integers(0, 2**64, 256, np.uint64, endpoint=False)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


class Texts(NamedTuple):
    """Concatenated bytes; text i is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray


def change_rows(docs, text_col: str, limit: int, change):
    """``docs`` with its own columns, through ``change(texts)`` of each block: which rows stay, and their new
    text column or None for the old one."""

    def run(batches):
        for block in blocks(batches, limit, text_col):
            keep, text = change(texts_of(block.column(text_col)))
            if text is not None:
                at = block.schema.get_field_index(text_col)
                block = block.set_column(at, block.schema.field(at), text)
            yield block.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


class Runs(NamedTuple):
    """Runs of bytes, such as words: text i has those from ``first[i]`` to ``first[i + 1]``."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        """The number of the text that each run belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def _lengths(column: pa.Array) -> np.ndarray:
    """Where the texts of a column would begin in a row, and the end; the bytes are not touched."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(size)])


def blocks(batches, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches in order, in slices whose texts have ``limit`` bytes or are one row."""
    for batch in batches:
        offsets = _lengths(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def runs(texts: Texts, inside: np.ndarray) -> Runs:
    """The maximal runs of bytes where ``inside`` holds; none goes over the end of a text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[texts.offsets] = True
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Runs(start, end, np.searchsorted(start, texts.offsets))


def words(texts: Texts) -> Runs:
    """Runs of bytes other than ASCII white space."""
    return runs(texts, ~SPACE[texts.data])


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finalizer of SplitMix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept by the worker up to the largest block so far."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = tuple(tables)
    return _powers[0][:n], _powers[1][:n]


def run_hashes(data: np.ndarray, spans: Runs) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; equal bytes have equal hashes in every block.

    A polynomial in an odd base, from running sums over the whole block.
    """
    if not len(spans.start):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    length = (spans.end - spans.start).astype(np.uint64)
    return mix((total[spans.end] - total[spans.start]) * inverse[spans.start] + length)


def sequence_hashes(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` values in a row and the place of each one's first value; none spans two texts."""
    last = len(values) - width + 1
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    made = np.zeros(last, np.uint64)
    for i in range(width):
        made = made * np.uint64(_BASE) + values[i:last + i]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keep = np.flatnonzero(text[:last] == text[width - 1:])
    return mix(made[keep]), keep


def segments(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of the segments of the given lengths, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths)


def pieces_array(data: np.ndarray, spans: Runs) -> pa.BinaryArray:
    """The bytes of the runs as an Arrow array."""
    length = spans.end - spans.start
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    if offsets[-1] == 0:
        flat = np.zeros(0, np.uint8)
    elif np.array_equal(spans.start[1:], spans.end[:-1]):
        flat = data[spans.start[0]:spans.end[-1]]
    else:
        cover = np.zeros(len(data) + 1, np.int8)
        np.add.at(cover, spans.start, 1)
        np.add.at(cover, spans.end, -1)
        flat = data[np.cumsum(cover[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]
    )
