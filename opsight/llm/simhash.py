"""SimHash fingerprints, linked within a few bits through the anchors of a covering code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opsight.llm import arrays
from opsight.llm.components import components
from opsight.session import scratch_path

BITS = 64
#: Hashes whose bits are counted at a time.
_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of the word shingles of a text, repeats included; 0 if it has no word."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    width = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - width + 1]
    ends = ends[width - 1:]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _ROWS):
        hashes = np.array([digest(line[a:b], 42) for a, b in
                           zip(starts[at:at + _ROWS].tolist(), ends[at:at + _ROWS].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``id``, ``tag`` (a hash of the text) and ``fp`` (64 bits as a long) per row."""

    def make(batches):
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            made = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in column), np.uint64, len(column))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "tag": batch.column("tag"),
                                              "fp": pa.array(made.view(np.int64))})

    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("tag"),
                       F.col(text_col).alias("text"))
    return flat.mapInArrow(make, "id long, tag long, fp long")


def block_layout(distance: int) -> list[tuple[int, int, int]]:
    """(first bit, bits of the Hamming code, free bits) of blocks of which one has at most one differing bit
    whenever the whole has at most ``distance``."""
    number, layout, at = distance // 2 + 1, [], 0
    for i in range(number):
        width = (BITS - at) // (number - i)
        coded = (1 << (width + 1).bit_length() - 1) - 1
        layout.append((at, coded, width - coded))
        at += width
    return layout


def anchors(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchors of fingerprints: anchor, place of its fingerprint in ``values``, whether it is the home one.

    In each block the anchors are the words of the perfect Hamming code of length 2^k - 1, times all values
    of the bits left over. Its covering radius is one, so each fingerprint has a home anchor within one bit.
    It is copied to every anchor within the radius plus the block's threshold of one, so two fingerprints that
    differ in one bit of the block meet at the home of either.
    """
    keys, places, homes = [], [], []

    def add(code: np.ndarray, rest: np.ndarray, at: np.ndarray, home: bool) -> None:
        keys.append(arrays.mix((code | rest << np.uint64(coded)) + np.uint64(block) * np.uint64(0xD1B54A32D192ED03)))
        places.append(at)
        homes.append(np.full(len(at), home))

    everyone = np.arange(len(values))
    for block, (begin, coded, free) in enumerate(block_layout(distance)):
        part = values >> np.uint64(begin)
        code = part & np.uint64((1 << coded) - 1)
        rest = part >> np.uint64(coded) & np.uint64((1 << free) - 1)
        syndrome = np.zeros(len(values), np.int64)
        for i in range(coded):
            syndrome ^= (code >> np.uint64(i) & np.uint64(1)).astype(np.int64) * (i + 1)
        off = syndrome > 0
        flip = np.where(off, np.uint64(1) << np.maximum(syndrome - 1, 0).astype(np.uint64), np.uint64(0))
        add(code ^ flip, rest, everyone, True)
        # the home again for others' homes, with one more free bit, and two if the fingerprint is at its anchor
        for i in range(free):
            add(code ^ flip, rest ^ np.uint64(1 << i), everyone, False)
            for j in range(i):
                at = np.flatnonzero(~off)
                add(code[at], rest[at] ^ np.uint64(1 << i | 1 << j), at, False)
        for i in range(1, coded + 1):
            other = syndrome ^ i
            at = np.flatnonzero(off & (other > i))
            add(code[at] ^ np.uint64(1 << i - 1) ^ (np.uint64(1) << (other[at] - 1).astype(np.uint64)), rest[at], at,
                False)
    return np.concatenate(keys), np.concatenate(places), np.concatenate(homes)


def links(prints: DataFrame, distance: int = 3) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints (``fp``) that differ in at most ``distance`` bits.

    Spark takes the anchors, dozens a fingerprint, for as many rows as there are fingerprints, so the join is told not
    to broadcast them.
    """

    def spread(batches):
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for begin in range(0, len(values), 1 << 14):
                some = values[begin:begin + (1 << 14)]
                anchor, place, home = anchors(some, distance)
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array(anchor.view(np.int64)), "fp": pa.array(some[place].view(np.int64)),
                    "home": pa.array(home),
                })

    spread_out = prints.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    at_home = spread_out.where("home").select("anchor", F.col("fp").alias("a"))
    copies = spread_out.select("anchor", F.col("fp").alias("b"))
    return at_home.join(copies.hint("merge"), "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def classes(docs: DataFrame, distance: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """id, tag, fp, component_id, root (the component's smallest fingerprint) and n_links per row of ``docs``."""
    path = scratch_path(docs.sparkSession, "fingerprints")
    fingerprints(docs, id_col, text_col, shingle).write.parquet(path)
    rows = docs.sparkSession.read.parquet(path)
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    path = scratch_path(docs.sparkSession, "links")
    links(prints, distance).write.parquet(path)
    pairs = docs.sparkSession.read.parquet(path)
    ends = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp")))
    degree = ends.groupBy("fp").agg(F.count("*").alias("n_links"))
    root = components(pairs).withColumnsRenamed({"node": "fp"})
    nodes = prints.join(root, "fp", "left").join(degree, "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    named = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(nodes.join(named, "root").select("fp", "component_id", "root", "n_links"), "fp")


def near_duplicates(docs: DataFrame, distance: int = 3, shingle: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id_col``, fingerprint (16 hex digits), component_id and n_links for every row of ``docs``.

    Rows of one fingerprint are one node, so exact and most near copies cost one row; distinct fingerprints
    meet at anchors, and their components come from joins. component_id is the smallest id
    reachable, n_links the number of other fingerprints linked to the row's own. A null or empty text has no
    words and fingerprint zero, linked like any other. Repeated rows give a row each; null ids
    are passed over when the smallest id is sought (it is null if a component has no other); an empty table
    gives no rows; other columns are not looked at.
    """
    return classes(docs, distance, shingle, id_col, text_col).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_links",
    )


def one_of_each(docs: DataFrame, distance: int = 3, shingle: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with its own columns, one row of each component: that of the smallest id, null ids last, then
    of the smallest hash of its text; of rows equal in both any one stays."""
    found = classes(docs, distance, shingle, id_col, text_col)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tag")).alias("k"))
    none = -(1 << 63)
    first = first.select(F.coalesce("k.id", F.lit(none)).alias("__id"), F.col("k.tag").alias("__tag"))
    marked = docs.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(none))).withColumn(
        "__tag", F.xxhash64(text_col))
    turn = F.row_number().over(Window.partitionBy("__id", "__tag").orderBy("__id"))
    return marked.join(first, ["__id", "__tag"]).withColumn("__turn", turn).where("__turn = 1").select(*docs.columns)
