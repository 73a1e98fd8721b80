"""Fingerprints of documents from closed syncmers, compared by the places of their anchors.

An anchor is a run of ``K`` bytes whose least inner run of ``S`` bytes, by a hash, is its first or its last one. Whether a
run is an anchor depends on its own bytes alone, so a passage has the same anchors at the same distances wherever
it stands, and any ``K - S`` runs in a row hold one. A fingerprint lists a text's anchors in order, each as the distance
from the one before and a hash; two fingerprints are alike as far as they share anchors that follow the same anchor at
the same distance.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm import arrays

#: Bytes of an anchor and of its inner runs.
K, S = 32, 8
#: Bits of an anchor's hash, under five of its distance; together four characters of base64.
HASH_BITS = 19
#: The distance of an anchor that stands for a whole text too short to have one.
WHOLE = 31
#: Bytes of text looked at at a time; anchors need no more context than their own bytes.
BLOCK_BYTES = 1 << 20
#: Bytes of text in a partition, and ranges of ids in one; most partitions.
PARTITION_BYTES, RANGES, MOST_PARTITIONS = 32 << 20, 4, 50_000

_BASE = 0x9E3779B97F4A7C15
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", np.uint8)
_VALUES = np.zeros(256, np.uint32)
_VALUES[_DIGITS] = np.arange(64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _chosen(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the closed syncmers of the bytes begin, and their hashes."""
    starts, hashes, inner = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], K - S
    for begin in range(0, len(data) - K + 1, BLOCK_BYTES):
        p = data[begin:begin + BLOCK_BYTES + K - 1].astype(np.uint64)
        n = len(p) - K + 1
        for step in (1, 2, 4):
            p = p[:-step] * _power(step) + p[step:]
        order = arrays.mix(p)
        # the least of inner + 1 values, from the least of 16
        least = order
        for step in (1, 2, 4, 8):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[:n], least[inner - 15:inner - 15 + n])
        at = np.flatnonzero((order[:n] == least) | (order[inner:inner + n] == least))
        run = p[at]
        for step in range(S, K, S):
            run = run * _power(S) + p[at + step]
        starts.append(at + begin)
        hashes.append(arrays.mix(run) >> np.uint64(64 - HASH_BITS))
    return np.concatenate(starts), np.concatenate(hashes)


def anchors(texts: arrays.Texts) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of each text, as distance and hash in one number; text i has those from ``first[i]`` to ``first[i + 1]``.

    The first distance is from the start of the text. A text without a syncmer, which has under ``2 * K - S`` bytes,
    has one anchor of its whole bytes.
    """
    data, offsets = texts
    start, value = _chosen(data)
    owner = np.searchsorted(offsets, start, "right") - 1
    inside = start + K <= offsets[owner + 1]
    start, value, owner = start[inside], value[inside], owner[inside]
    before = np.concatenate([[0], start[:-1]])
    new = np.ones(len(owner), bool)
    new[1:] = owner[1:] != owner[:-1]
    gap = start - np.where(new, offsets[owner], before)
    number = gap.astype(np.uint32) << np.uint32(HASH_BITS) | value.astype(np.uint32)
    none = np.flatnonzero(np.bincount(owner, minlength=len(offsets) - 1) == 0)
    whole = [WHOLE << HASH_BITS | zlib.crc32(data[offsets[i]:offsets[i + 1]]) >> 32 - HASH_BITS for i in none]
    order = np.argsort(np.concatenate([owner, none]), kind="stable")
    owner = np.concatenate([owner, none])[order]
    first = np.searchsorted(owner, np.arange(len(offsets)))
    return np.concatenate([number, np.array(whole, np.uint32)])[order], first


def to_text(number: np.ndarray, first: np.ndarray) -> pa.StringArray:
    """Anchors as text, four characters each."""
    digits = np.empty((len(number), 4), np.uint8)
    for k in range(4):
        digits[:, k] = _DIGITS[number >> np.uint32(18 - 6 * k) & np.uint32(63)]
    return pa.StringArray.from_buffers(len(first) - 1, pa.py_buffer((first * 4).astype(np.int32)), pa.py_buffer(digits))


def from_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The anchors that ``to_text`` wrote; a null has none."""
    data, offsets = arrays.texts_of(column)
    digits = _VALUES[data].reshape(-1, 4)
    return digits[:, 0] << 18 | digits[:, 1] << 12 | digits[:, 2] << 6 | digits[:, 3], offsets // 4


def _links(number: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every anchor with the hash of the one before it in its text, and the text's number."""
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    low = number.astype(np.int64)
    before = np.concatenate([[0], low[:-1] & (1 << HASH_BITS) - 1])
    before[first[:-1][np.diff(first) > 0]] = 1 << HASH_BITS  # the start of the text
    return before << 24 | low, owner


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each pair of fingerprints, one of ``a`` and one of ``b``: twice the shared links by the links of both,
    repeats counted; 1 if neither has any."""
    sides = []
    for number, first in (a, b):
        link, owner = _links(number, first)
        order = np.lexsort((link, owner))
        link, owner = link[order], owner[order]
        new = np.ones(len(link), bool)
        new[1:] = (link[1:] != link[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        sides.append((link[at], owner[at], np.diff(np.append(at, len(link)))))
    link, owner, times = (np.concatenate(x) for x in zip(*sides))
    order = np.lexsort((link, owner))
    link, owner, times = link[order], owner[order], times[order]
    met = np.flatnonzero((link[1:] == link[:-1]) & (owner[1:] == owner[:-1]))
    both = np.diff(a[1]) + np.diff(b[1])
    shared = np.bincount(owner[met], np.minimum(times[met], times[met + 1]), len(both))
    return np.where(both > 0, 2 * shared / np.maximum(both, 1), 1.0)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``fingerprint`` of every row; a null text is empty, equal texts have equal fingerprints."""

    def run(batches):
        for batch in batches:
            for block in arrays.blocks([batch], BLOCK_BYTES):
                yield pa.RecordBatch.from_pydict({
                    "id": block.column("id"), "fingerprint": to_text(*anchors(arrays.texts_of(block.column("text"))))})

    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return flat.mapInArrow(run, "id long, fingerprint string").withColumnRenamed("id", id_col)


def with_likeness(pairs: DataFrame, left: str, right: str, out: str = "likeness") -> DataFrame:
    """``pairs`` with the likeness, 0 to 1, of the fingerprints in two of its columns; a null one has no anchors."""
    from pyspark.sql.types import DoubleType, StructField, StructType

    def run(batches):
        for batch in batches:
            found = likeness(from_text(batch.column(left)), from_text(batch.column(right)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, out])

    return pairs.mapInArrow(run, StructType([*pairs.schema.fields, StructField(out, DoubleType())]))


def _edited(texts: arrays.Texts, follows: np.ndarray) -> tuple[np.ndarray, arrays.Texts]:
    """Code points of each text, and each but the last with its last half replaced by the start of the next text, where
    ``follows`` holds, else cut off."""
    data, offsets = texts
    point = np.flatnonzero(data & 0xC0 != 0x80)
    first = np.searchsorted(point, offsets)
    chars = np.diff(first)
    bound = np.append(point, len(data))
    n, half = chars[:-1], chars[:-1] // 2
    keep = bound[first[:-2] + n - half]
    keep = np.where(half > 0, keep, offsets[1:-1])
    taken = np.where(follows, np.minimum(half, chars[1:]), 0)
    until = np.where(taken == chars[1:], offsets[2:], bound[first[1:-1] + taken])
    until = np.where(taken > 0, until, offsets[1:-1])
    raw = data.tobytes()
    made = [raw[a:b] + raw[b2:c] for a, b, b2, c in zip(offsets[:-2], keep, offsets[1:-1], until)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in made], dtype=np.int64)])
    return chars, arrays.Texts(np.frombuffer(b"".join(made), np.uint8), ends)


def _compare(block: pa.RecordBatch) -> pa.RecordBatch:
    """The results of a block's rows, but for the last, which only follows."""
    texts = arrays.texts_of(block.column("text"))
    number = block.column("id")
    group = block.column("bucket").to_numpy()
    named = number.is_valid().to_numpy(zero_copy_only=False)
    follows = (group[1:] == group[:-1]) & named[:-1]
    chars, edited = _edited(texts, follows)
    mine, theirs = anchors(texts), anchors(edited)
    rows = len(chars) - 1
    first = mine[1]
    own = mine[0][:first[rows]], first[:-1]
    # a row that nothing follows is compared with an empty text
    after = np.where(follows, np.diff(first)[1:], 0)
    shifted = mine[0][first[1]:], first[1:] - first[1]
    near_next = likeness(own, shifted)
    if not follows.all():
        empty = anchors(arrays.Texts(np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)))
        near_next = np.where(after > 0, near_next, likeness(own, empty))
    out = edited.data.tobytes()
    made = pa.RecordBatch.from_pydict({
        "id": number[:rows], "n_chars": pa.array(chars[:rows]),
        "edited_sha256": pa.array([hashlib.sha256(out[a:b]).hexdigest() for a, b in zip(edited.offsets, edited.offsets[1:])],
                                  pa.string()),
        "fingerprint": to_text(*own), "edited_fingerprint": to_text(*theirs),
        "near_edited": pa.array(likeness(own, theirs)), "near_next": pa.array(near_next),
    })
    return made.filter(pa.array(~block.column("guest").to_numpy(zero_copy_only=False)[:rows]))


def _in_order(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) dealt out in ranges of ids (bucket), each in order and followed by a copy of the row
    that comes next (guest), the first row of all after the last.

    The ranges come from percentiles of the ids. Only their bounds and smallest ids reach the driver, four times
    ``MOST_PARTITIONS`` numbers at most.
    """
    from pyspark.ml.feature import Bucketizer

    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES)), MOST_PARTITIONS)
    ranges = partitions * RANGES
    ids = docs.select("id").where("id IS NOT NULL")
    cuts = ids.agg(F.percentile_approx("id", [k / ranges for k in range(1, ranges)], 50 * ranges)).first()[0] or []
    splits = [-np.inf, *sorted({0.0, *map(float, cuts)}), np.inf]  # the least number of ranges is two

    def bucketed(df: DataFrame) -> DataFrame:
        # a double keeps the order of ids, which is all that a range needs
        cut = Bucketizer(splits=splits, inputCol="at", outputCol="range", handleInvalid="keep")
        return cut.transform(df.withColumn("at", F.col("id").cast("double"))).withColumn(
            "bucket", F.col("range").cast("long")).drop("at", "range")

    heads = [(r.bucket, r.least) for r in bucketed(ids).groupBy("bucket").agg(F.min("id").alias("least")).collect()]
    heads.sort()
    before = spark.createDataFrame([(least, heads[k - 1][0]) for k, (_, least) in enumerate(heads)],
                                   "least long, other long")
    rows = bucketed(docs.where("id IS NOT NULL")).join(F.broadcast(before), F.col("id") == F.col("least"), "left")
    places = F.array(F.struct("bucket", F.lit(False).alias("guest")),
                     F.struct(F.col("other").alias("bucket"), F.lit(True).alias("guest")))
    rows = rows.select("id", "text", F.explode(F.filter(places, lambda p: p["bucket"].isNotNull())).alias("to")).select(
        "id", "text", "to.bucket", "to.guest")
    # a row without id follows none, so it may stand anywhere
    loose = docs.where("id IS NULL").select("id", "text", (-1 - F.pmod(F.xxhash64("text"), F.lit(ranges))).alias("bucket"),
                                            F.lit(False).alias("guest"))
    return rows.unionByName(loose).repartition(partitions, "bucket").sortWithinPartitions("bucket", "guest", "id", "text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint and that of its text after an edit, and how alike it is to that one and to the next row's.

    The edit puts the start of the next text, by ascending id, in place of the last half of the code points; after
    the last row comes the first. Columns: ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. A null text is empty. Rows of one id follow each other by their text; a row
    without id is followed by nothing, which counts as an empty text. A single row is its own next one. An empty table gives
    none; other columns are not looked at. Texts move once, in ranges of ids that have as many rows each.
    """

    def run(batches):
        last = None
        for batch in batches:
            batch = batch if last is None else pa.concat_batches([last, batch])
            size = arrays._lengths(batch.column("text"))
            begin = 0
            while begin < batch.num_rows - 1:
                end = int(np.searchsorted(size, size[begin] + BLOCK_BYTES, "right")) - 1
                end = min(max(end, begin + 1), batch.num_rows - 1)
                yield _compare(batch.slice(begin, end - begin + 1))
                begin = end
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            # nothing follows the last row: it is a copy for the one before, or has no id
            nothing = pa.RecordBatch.from_pydict({"id": pa.nulls(1, pa.int64()), "text": pa.array([""]),
                                                  "bucket": pa.array([-1 << 62]), "guest": pa.array([True])})
            yield _compare(pa.concat_batches([last, nothing.cast(last.schema)]))

    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return _in_order(flat).mapInArrow(
        run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double").withColumnRenamed("id", id_col)
