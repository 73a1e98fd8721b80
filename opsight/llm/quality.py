"""Line-first cleaning: lines that break a rule go, and documents that lose too much text go with them."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays

#: Bytes of text handled together; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20
#: A line is navigation if so many of its words, and this many at least, are only separators.
SEPARATOR_SHARE, SEPARATORS = 0.25, 2
#: A line is noise if so many of its words carry one of the symbols, or shouting marks.
SYMBOL_SHARE = 0.4
#: A line stutters if so many of its words equal the word before.
STUTTER_SHARE = 0.5
#: A line without an end mark goes if it has fewer words than this.
SHORT_LINE = 4
#: A document goes if its lines that stay hold less than this share of its word characters.
KEPT_SHARE = 0.5

# Fixed values
SYMBOLS = b"#*$%&|<>"
END_MARKS = [".", "!", "?", ":", ";", "\"", "'", ")", "”", "’", "»", "…", "。", "！", "？"]
NAVIGATION_MARKS = ["|", ">", "<", "»", "›", "•", "·", "/", "::", "→", "←"]
BOILERPLATE = [
    "all rights reserved", "licensed under", "released under the", "this work is licensed", "copyright (c)",
    "cookie policy", "uses cookies", "accept cookies", "privacy policy", "terms of service", "terms of use",
    "enable javascript", "subscribe to our newsletter", "skip to content", "lorem ipsum", "powered by wordpress",
]

_BOILERPLATE = re.compile(b"|".join(re.escape(p.encode()) for p in BOILERPLATE))
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_WIDTH = 8


def _set(values: np.ndarray, strings: list[str], data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marks the ends in front of which one of the strings stands."""
    for s in strings:
        raw = np.frombuffer(s.encode(), np.uint8)
        there = end >= len(raw)
        for i, byte in enumerate(raw):
            there &= data[np.maximum(end - len(raw) + i, 0)] == byte
        values |= there
    return values


def _per_run(flags: np.ndarray, spans: arrays.Runs) -> np.ndarray:
    """How many flagged bytes each run holds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[spans.end] - total[spans.start]


def _keys(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    return arrays.mix(hashes ^ arrays.mix(text.astype(np.uint64) + np.uint64(1)))


def measures(texts: arrays.Texts) -> tuple[dict[str, np.ndarray], np.ndarray, arrays.Runs]:
    """Counts per text, which lines stay, and the lines."""
    data, offsets = texts
    n = len(offsets) - 1
    word, line = arrays.words(texts), arrays.runs(texts, data != 0x0A)
    text_of_word, text_of_line = word.text_of(), line.text_of()
    visible = ~arrays.SPACE[data]
    begins = visible & ((data & 0xC0) != 0x80)  # the first byte of a character
    symbol = _IS_SYMBOL[data]
    first_word = np.searchsorted(word.start, line.start)
    end_word = np.searchsorted(word.start, line.end)
    in_line = end_word - first_word
    hashes = arrays.run_hashes(data, word)

    worded = np.flatnonzero(in_line > 0)
    owner = text_of_line[worded]
    lines_of = arrays.Runs(line.start[worded], line.end[worded], np.searchsorted(owner, np.arange(n + 1)))
    _, earliest = np.unique(_keys(arrays.run_hashes(data, lines_of), owner), return_index=True)
    fresh = np.bincount(owner[earliest], minlength=n)

    windows, at = arrays.sequence_hashes(hashes, word.first, _WIDTH)
    _, inverse, times = np.unique(_keys(windows, text_of_word[at]), return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    cover = np.bincount(again, minlength=len(hashes) + 1) - np.bincount(again + _WIDTH, minlength=len(hashes) + 1)[
        :len(hashes) + 1]
    covered = np.cumsum(cover)[:len(hashes)] > 0

    def per_line(values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[end_word] - total[first_word]

    noisy = (_per_run(symbol, word) > 0) | _set(np.zeros(len(word.end), bool), ["!!"], data, word.end)
    marks = _set(np.zeros(len(word.end), bool), NAVIGATION_MARKS, data, word.end)
    separator = marks & (_per_run(begins, word) <= 2)
    last = word.end[np.maximum(end_word - 1, 0)] if len(word.end) else np.zeros(len(in_line), np.int64)
    ended = _set(np.zeros(len(last), bool), END_MARKS, data, last) & (in_line > 0)
    separators = per_line(separator)
    fails = (separators >= SEPARATORS) & (separators > SEPARATOR_SHARE * in_line)
    fails |= per_line(noisy) > SYMBOL_SHARE * in_line
    same = np.zeros(len(hashes), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[first_word[in_line > 0]] = False
    fails |= per_line(same) > STUTTER_SHARE * in_line
    fails |= ~ended & (in_line < SHORT_LINE)
    found = [m.start() for m in _BOILERPLATE.finditer(arrays.LOWER[data].tobytes())]
    hit = np.searchsorted(line.start, np.array(found, np.int64), "right") - 1
    fails[hit[hit >= 0]] = True
    stays = ~fails | (in_line == 0)

    letters = _per_run(begins, line)
    letters_of = np.bincount(text_of_line, weights=letters, minlength=n).astype(np.int64)
    left = np.bincount(text_of_line, weights=letters * stays, minlength=n).astype(np.int64)
    n_words = np.diff(word.first)
    repeated = np.bincount(text_of_word, weights=covered, minlength=n).astype(np.int64)
    failed = (n_words < 20) | (100 * repeated > 30 * n_words)
    whole = arrays.Runs(offsets[:-1], offsets[1:], np.arange(n + 1))
    return {
        "n_words": n_words, "word_chars": letters_of, "n_symbols": _per_run(symbol, whole),
        "n_dup_lines": np.bincount(owner, minlength=n) - fresh, "n_repeat_words": repeated,
        "n_removed_lines": np.bincount(text_of_line, weights=~stays, minlength=n).astype(np.int64),
        "kept_chars": left, "base_failed": failed, "kept": ~failed & (left >= KEPT_SHARE * letters_of),
    }, stays, line


def without_lines(texts: arrays.Texts, stays: np.ndarray, line: arrays.Runs) -> pa.Array:
    """The texts without the lines that don't stay; such a line takes the line break behind it along."""
    drop = np.zeros(len(texts.data) + 1, np.int32)
    gone = ~stays
    np.add.at(drop, line.start[gone], 1)
    np.add.at(drop, np.minimum(line.end[gone] + 1, texts.offsets[1:][line.text_of()[gone]]), -1)
    keep = np.cumsum(drop[:-1]) == 0
    place = np.concatenate([[0], np.cumsum(keep)])[texts.offsets].astype(np.int64)
    left = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(place) - 1, [None, pa.py_buffer(place), pa.py_buffer(texts.data[keep])])
    return left.cast(pa.large_string()).cast(pa.string())


def cleaned(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns: kept rows only, their texts without the failing lines.

    What is said of ``clean_lines`` holds here; a null text is rejected, as it has no words.
    """

    def change(texts):
        found, stays, line = measures(texts)
        return found["kept"], without_lines(texts, stays, line)

    return arrays.change_rows(docs, text_col, BLOCK_BYTES, change)


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                with_text: bool = False) -> DataFrame:
    """The counts, the verdict and, with ``with_text``, the text without its failing lines, per row.

    A line fails if it is navigation (separators between words), noise (symbols on its words, shouting or
    stutter), boilerplate, or has no end mark and is very short. A document is kept unless the base rules
    fail it (fewer than 20 words, or over 30 % of them in repeated windows of eight) or the lines that stay
    hold under half of its characters. Whole texts are read. A null text has no words and fails; an empty
    line neither fails nor counts; repeated rows and null ids give a row each; an empty table gives none;
    other columns are not looked at.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_lines", "kept_chars"]

    def judge(batches):
        for block in arrays.blocks(batches, BLOCK_BYTES):
            texts = arrays.texts_of(block.column("text"))
            found, stays, line = measures(texts)
            columns = {"id": block.column("id"), **{c: pa.array(v) for c, v in found.items()}}
            if with_text:
                columns["clean"] = without_lines(texts, stays, line)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean"
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made = flat.mapInArrow(judge, schema + ", clean string" * with_text)
    return made.withColumnsRenamed({"id": id_col, "clean": text_col} if with_text else {"id": id_col})
