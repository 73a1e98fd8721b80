"""Best-fit-decreasing packing of tokenised documents into sequences of one length."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opsight.llm import arrays
from opsight.session import scratch_path

#: Bytes of text that are tokenised together; a longer document is a block of its own.
BLOCK_BYTES = 24 << 20
#: Distinct words given to the tokenizer in one call.
_CALL = 4096
_ready: dict[str, object] = {}

# Bytes that may end or begin a white-space character outside ASCII (U+0085, U+00A0, U+1680, U+2000 to
# U+200A, U+2028, U+2029, U+202F, U+205F, U+3000); next to those no text is cut.
_BEFORE_END = np.zeros(256, bool)
_BEFORE_END[[0xC2, 0x80, 0x81, 0x9A]] = True
_END = np.zeros(256, bool)
_END[[*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True
_BEGIN = np.zeros(256, bool)
_BEGIN[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def split_words(texts: arrays.Texts) -> arrays.Runs:
    """Cuts in front of single spaces between two other characters, where byte-level tokenizers cut too."""
    data, offsets = texts
    n = len(data)
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < n - 1)]
    left, right = data[at - 1], data[at + 1]
    at = at[(left > 0x20) & (right > 0x20) & ~(_END[left] & _BEFORE_END[data[np.maximum(at - 2, 0)]]) & ~_BEGIN[right]]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    # the neighbours must be of the same text
    cut[offsets[1:] - 1] = False
    cut[offsets] = True
    cut[n] = False
    start = np.flatnonzero(cut)
    return arrays.Runs(start, np.append(start[1:], n) if len(start) else start, np.searchsorted(start, offsets))


def _encoder(path: str, ranks: str | None):
    """The function that gives the ids of a list of words, made once by each Python worker."""
    if (path, ranks) not in _ready:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def encode(words: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]

        _ready[path, ranks] = encode
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as lines:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            same = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                     special_tokens={}).encode_ordinary
            special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            _ready[path, ranks] = lambda words: [
                encode([w])[0] if any(s in w for s in special) else same(w) for w in words
            ]
    return _ready[path, ranks]


def token_ids(texts: arrays.Texts, path: str, ranks: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row and where each text's ids begin; each distinct word is encoded once."""
    spans = split_words(texts)
    coded = arrays.pieces_array(texts.data, spans).dictionary_encode()
    encode, ids, lengths = _encoder(path, ranks), [], []
    for begin in range(0, len(coded.dictionary), _CALL):
        made = encode([w.decode("utf-8") for w in coded.dictionary.slice(begin, _CALL).to_pylist()])
        ids.append(np.array(list(itertools.chain.from_iterable(made)), np.uint32))
        lengths += map(len, made)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    length = np.array(lengths, np.int64)
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    begin = (np.cumsum(length) - length)[code]
    count = length[code]
    places = np.concatenate([[0], np.cumsum(count)])
    return flat[np.repeat(begin, count) + arrays.segments(count)], places[spans.first]


class Capacities:
    """A segment tree over remaining capacities: which has open sequences, found in logarithmic time."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.size)

    def set(self, remaining: int, there: bool) -> None:
        at = self.size + remaining
        self.open[at] = there
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest capacity of at least ``length`` that has an open sequence."""
        at = self.size + length
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.size:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing of ``counts[length]`` items per length, as ranges.

    Items of one length are alike, so the plan handles equal sequences together: a row
    (length, first item, items per sequence, first sequence, used) says that the length's items from that
    one on fill sequences from that one on, so many each, behind ``used`` tokens. The rows depend on the
    lengths, of which there are ``capacity`` at most, not on the number of items.
    """
    tree, groups, rows, made = Capacities(capacity), defaultdict(list), [], 0

    def put(remaining: int, first: int, number: int) -> None:
        if remaining and number:
            groups[remaining].append((first, number))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        item, n = 0, counts[length]
        while item < n:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first, number = capacity, made, -(-(n - item) // (capacity // length))
                made += number
            else:
                first, number = groups[remaining].pop()
                if not groups[remaining]:
                    tree.set(remaining, False)
            # once an item is in, its sequence is the tightest for the next one, until no more fits
            each = remaining // length
            full = min(number, (n - item) // each)
            if full == 0:
                full, each = 1, n - item
            rows.append((length, item, each, first, capacity - remaining))
            put(remaining, first + full, number - full)
            put(remaining - each * length, first, full)
            item += full * each
    return np.array(rows, np.int64).reshape(-1, 5)


def tokenised_pieces(docs: DataFrame, tokenizer: str, ranks: str | None, capacity: int, end_id: int,
                     with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """A row per piece of a document, with its place among the pieces of its length in its block."""

    def cut(batches):
        from pyspark import TaskContext

        base, at = TaskContext.get().partitionId() << 32, 0
        for block in arrays.blocks(batches, BLOCK_BYTES):
            texts = arrays.texts_of(block.column("text"))
            ids, first = token_ids(texts, tokenizer, ranks)
            n = block.num_rows
            total = np.diff(first) + 1
            whole = np.full(len(ids) + n, end_id, "<u4")
            begin = first[:-1] + np.arange(n)
            whole[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(first))] = ids
            parts = -(-total // capacity)
            doc = np.repeat(np.arange(n), parts)
            piece = arrays.segments(parts)
            # the first piece is the one that may be shorter, the others are full sequences
            head = total - (parts - 1) * capacity
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
            length = np.where(piece == 0, head[doc], capacity)
            here = begin[doc] + start
            spans = [whole[a:b] for a, b in zip(here.tolist(), (here + length).tolist())]
            order = np.argsort(length, kind="stable")
            rank = np.empty(len(length), np.int64)
            _, times = np.unique(length, return_counts=True)
            rank[order] = arrays.segments(times)
            columns = {
                "id": block.column("id").take(pa.array(doc)), "piece": pa.array(piece.astype(np.int32)),
                "start": pa.array(start), "length": pa.array(length),
                "ids_crc32": pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                "block": pa.array(np.full(len(doc), base + at)), "rank": pa.array(rank),
            }
            if with_ids:
                columns["ids"] = pa.array([s.astype(np.int32) for s in spans], pa.list_(pa.int32()))
            at += 1
            yield pa.RecordBatch.from_pydict(columns)

    schema = "id long, piece int, start long, length long, ids_crc32 long, block long, rank long"
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    path = scratch_path(docs.sparkSession, "pieces")
    flat.mapInArrow(cut, schema + ", ids array<int>" * with_ids).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = 2048, end_id: int = 0,
         with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Best-fit-decreasing packing of ``docs`` into sequences of at most ``capacity`` tokens.

    A document is its ids by ``tokenizer`` (a file that executors can read) and then ``end_id``; ``ranks``
    may name the same vocabulary as a rank file, whose library is faster and gives the same ids. A longer one
    is cut into pieces of ``capacity``, of which the first may be shorter. Returns a row per piece:
    ``id_col``, piece, start, length, ids_crc32, sequence_id, offset, and with ``with_ids`` its ids.

    Only the number of pieces of each length, ``capacity`` numbers at most, comes to the driver, where the
    plan is made; each piece finds its sequence from its number among those of its length. Ties, pieces of one
    length, are taken by block. A null text is an empty one and gives the end id alone; repeated rows
    and null ids are packed like others; an empty table gives no rows; other columns are not looked at.
    """
    pieces = tokenised_pieces(docs, tokenizer, ranks, capacity, end_id, with_ids, id_col, text_col)
    here = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in here.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = here.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    shift = np.int64(1) << np.int64(48)
    keys = plan[:, 0] * shift + plan[:, 1]
    order = np.argsort(keys)
    plan, keys = plan[order], keys[order]
    columns = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            item = batch.column("item").to_numpy()
            at = np.searchsorted(keys, length * shift + item, "right") - 1
            into, turn = np.divmod(item - plan[at, 1], plan[at, 2])
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in columns},
                "sequence_id": pa.array(plan[at, 3] + into), "offset": pa.array(plan[at, 4] + turn * length),
            })

    schema = "id long, piece int, start long, length long, ids_crc32 long, " + "ids array<int>, " * with_ids + (
        "sequence_id long, offset long")
    numbered = pieces.join(bases, ["length", "block"]).select(*columns, (F.col("base") + F.col("rank")).alias("item"))
    return numbered.mapInArrow(place, schema).withColumnRenamed("id", id_col)
