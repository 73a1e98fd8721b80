"""Token counts of documents from the counts of their distinct pre-tokens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays, wordtable

#: Bytes of the space mark U+2581, which the piece library takes for a space.
MARK = bytes("▁", "utf-8")
_ready: dict[str, object] = {}


def split_pieces(texts: arrays.Texts) -> tuple[np.ndarray, arrays.Runs]:
    """Pre-tokens: the text is cut at each space that follows a character other than a space, and that
    space is dropped.

    No piece of the vocabulary holds a space mark after another character (``piece_counts`` checks it), so
    no merge goes over a cut, and the library puts the dropped space back as the mark it adds in front of
    every text. A space after a literal mark is no cut.
    """
    data, offsets = texts
    n = len(data)
    space = data == 0x20
    before = np.zeros(n, bool)
    before[1:] = ~space[:-1]
    cut = space & before
    if n > 3:
        mark = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
        cut[3:] &= ~mark[:-1]
    begin = offsets[:-1]
    cut[begin[begin < n]] = False
    filled = np.flatnonzero(np.diff(offsets) > 0)
    at = np.flatnonzero(cut)
    start = np.sort(np.concatenate([begin[filled], at + 1]))
    end = np.sort(np.concatenate([offsets[1:][filled], at]))
    owner = np.searchsorted(offsets, np.concatenate([begin[filled], at]), "right") - 1
    return data, arrays.Runs(start, end, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(offsets) - 1))]))


def _processor(model: str):
    """The library's processor, loaded once by each Python worker."""
    if model not in _ready:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model)
        mark = MARK.decode()
        if any(mark in processor.id_to_piece(i).lstrip(mark) for i in range(processor.get_piece_size())):
            raise ValueError("a piece holds a space inside, so texts can't be cut at spaces")
        _ready[model] = processor
    return _ready[model]


def piece_counts(words: DataFrame, model: str) -> DataFrame:
    """``words`` (word, places) as (places, value), the number of its pieces; each is encoded once, on its own."""

    def count(batches):
        processor = _processor(model)
        for batch in batches:
            word = batch.column("word").to_pylist()
            # an empty pre-token stands for a lone space, which is one piece
            lengths = [max(1, len(ids)) for ids in processor.encode([w.decode("utf-8") for w in word], num_threads=1)]
            yield pa.RecordBatch.from_pydict({"places": batch.column("places"), "value": pa.array(lengths, pa.int64())})

    return words.select("word", "places").mapInArrow(count, "places array<bigint>, value long")


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``id_col``, n_bytes, n_tokens and over_limit for every row of ``docs``.

    The distinct pre-tokens of the corpus are encoded once each; their counts are joined to the documents'
    pre-token frequencies and summed, and no ids are kept. ``model`` is a path that the executors can read.
    A null text counts as empty and has no tokens. Rows are taken as they come: repeated rows and null ids
    give a row each, an empty table gives none, and other columns are not looked at.
    """
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.lit(False).alias("flag"), F.lit(0).cast("long").alias("tag"))
    batches, words = wordtable.write_batches(flat, split_pieces, "pretokens")
    return wordtable.sum_per_document(
        batches, piece_counts(words, model), {"n_tokens": lambda v: v}, {"n_tokens": "long"}).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"),
    )
