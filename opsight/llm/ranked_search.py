"""Ranked search over whole texts by K2-treaps of the grid of terms and documents.

The grid is cut into blocks of documents. In each block a quadtree over (term row, document column) stores the largest
impact of every cell that holds a posting, as the step down from its parent, and four bits for the quadrants that
have any. A query descends with one path per term: all paths stand at the same range of documents, whose score cannot
exceed the sum of the cells' maxima times the terms' weights, and the range with the highest such bound is split first.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from opsight.llm import arrays
from opsight.session import scratch_path

#: Bytes of text in a block of documents, of which so many are cut into terms at a time; a longer text is a block.
BLOCK_BYTES, CUT_BYTES = 16 << 20, 4 << 20
#: Bytes of the items' terms that are looked up at a time.
PACK_BYTES = 1 << 20
#: How many documents are returned for an item.
BEST = 10
#: Ranges of an item that are split together, and items that share a store of nodes.
AT_ONCE, ITEMS = 64, 64
#: Terms are runs of characters other than these, with A-Z in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_BITS = np.array([bin(i).count("1") for i in range(16)], np.int64)
_LAST = (1 << 63) - 1  # in the order of documents, one without an id is behind all
_INDEX = "ids array<bigint>, first binary, terms binary, ends binary, df binary, height int, top long, quadrants binary, " \
         "steps binary"


class Index(NamedTuple):
    """A written index: its folder, the documents with a term, and all their terms."""

    path: str
    documents: int
    terms: int


def _pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32 by byte, as the higher ones are mostly zero."""
    return zstandard.compress(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _terms(column: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The terms of the texts and the number of the text each is in, some texts at a time."""
    at = 0
    for block in arrays.blocks([pa.RecordBatch.from_arrays([column], ["text"])], CUT_BYTES):
        texts = arrays.texts_of(block.column(0))
        spans = arrays.runs(texts, arrays.WORD_CHARACTER[texts.data])
        yield arrays.pieces_array(arrays.LOWER[texts.data], spans).cast(pa.binary()), spans.text_of() + at
        at += block.num_rows


def _sizes(docs: DataFrame) -> tuple[int, int]:
    """The documents that have a term, and all terms with repeats."""

    def count(batches):
        for batch in batches:
            n = []
            for block in arrays.blocks([batch], CUT_BYTES):
                texts = arrays.texts_of(block.column("text"))
                n.append(np.diff(arrays.runs(texts, arrays.WORD_CHARACTER[texts.data]).first))
            n = np.concatenate([np.zeros(0, np.int64), *n])
            yield pa.RecordBatch.from_pydict({"d": pa.array([int((n > 0).sum())]), "l": pa.array([int(n.sum())])})

    found = docs.select("text").mapInArrow(count, "d long, l long").agg(F.sum("d"), F.sum("l")).first()
    return found[0] or 0, found[1] or 0


def _spread(v: np.ndarray) -> np.ndarray:
    """The lower 32 bits with a zero before each."""
    v = v.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        v = (v | v << np.uint64(shift)) & np.uint64(mask)
    return v


def treap(row: np.ndarray, column: np.ndarray, value: np.ndarray, height: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The quadtree of different cells of a grid of 2^height rows and columns: its largest value, the
    quadrants of each inner node, from the top and in order, and each other node's step below its parent's value."""
    code = _spread(row) << np.uint64(1) | _spread(column)
    order = np.argsort(code)
    code, value = code[order], value[order]
    quadrants, steps = [], []
    for _ in range(height):
        above = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], above[1:] != above[:-1]]))
        most = np.maximum.reduceat(value, first)
        quadrants.append(np.bitwise_or.reduceat(1 << (code & np.uint64(3)).astype(np.uint8), first).astype(np.uint8))
        steps.append(np.repeat(most, np.diff(np.append(first, len(code)))) - value)
        code, value = above[first], most
    return int(value[0]), np.concatenate(quadrants[::-1]), np.concatenate(steps[::-1])


def impacts(count: np.ndarray, length: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term's weight is multiplied by, from its occurrences in a document of so many terms."""
    m = 10 + 90 * length * documents // terms
    return 1_000_000_000 * count // (1000 * count + 8 * m)


def _indexed(block: pa.RecordBatch, documents: int, terms: int) -> dict | None:
    """The index of a block of documents, in which equal texts share a column, or None if it has no terms.

    Rows go from the most frequent term to the rarest, and by first column among equals, so that rare terms of a
    text stand side by side.
    """
    ids = block.column("id")
    coded = block.column("text").dictionary_encode()
    text = coded.indices.to_numpy(zero_copy_only=False)
    parts, owners = zip(*_terms(coded.dictionary))
    word = pa.chunked_array(parts, pa.binary()).combine_chunks().dictionary_encode()
    known, owner = len(word.dictionary), np.concatenate(owners)
    if not known:
        return None
    texts = len(coded.dictionary)
    length = np.bincount(owner, minlength=texts)
    pair, count = np.unique(owner * known + word.indices.to_numpy(), return_counts=True)
    owner, term = np.divmod(pair, known)

    # texts alike stand side by side: by their commonest term, then by length
    rank = np.empty(known, np.int64)
    rank[np.argsort(-np.bincount(term, minlength=known), kind="stable")] = np.arange(known)
    commonest = np.full(texts, known)
    heavy = np.lexsort((rank[term], -count, owner))
    begin = heavy[np.concatenate([[True], owner[heavy][1:] != owner[heavy][:-1]])]
    commonest[owner[begin]] = rank[term[begin]]
    order = np.lexsort((length, commonest))
    order = order[length[order] > 0]
    places = np.full(texts, -1)
    places[order] = np.arange(len(order))
    key = pc.fill_null(ids, _LAST).to_numpy()
    rows = np.lexsort((key, ~ids.is_valid().to_numpy(zero_copy_only=False), places[text]))
    rows = rows[length[text[rows]] > 0]
    column = places[owner]
    copies = np.bincount(places[text[rows]], minlength=len(order))

    lowest = np.full(known, len(order))
    np.minimum.at(lowest, term, column)
    shown = np.lexsort((lowest, -np.bincount(term, minlength=known)))
    row = np.empty(known, np.int64)
    row[shown] = np.arange(known)
    value = impacts(count, length[owner], documents, terms)
    some = value > 0
    if not some.any():
        return None
    height = max(1, int(known - 1).bit_length(), int(len(order) - 1).bit_length())
    top, quadrants, steps = treap(row[term[some]], column[some], value[some], height)
    names = word.dictionary.take(pa.array(shown))
    return {
        "ids": ids.take(pa.array(rows)).to_pylist(), "first": _pack(np.concatenate([[0], np.cumsum(copies)])),
        "terms": zstandard.compress(b"".join(names.to_pylist()), 3), "ends": _pack(np.cumsum(pc.binary_length(names).to_numpy())),
        "df": _pack(np.bincount(term, copies[column], known).astype(np.int64)[shown]), "height": height, "top": top,
        "quadrants": zstandard.compress(quadrants.tobytes(), 3), "steps": _pack(steps),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """An index of all rows in the shared folder, a row per block; nothing of it passes the driver but two counts."""
    flat = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    documents, terms = _sizes(flat)

    def build(batches):
        for block in arrays.blocks(batches, BLOCK_BYTES):
            made = _indexed(block, documents, terms)
            if made:
                yield pa.RecordBatch.from_pylist([made], schema=kinds)

    kinds = pa.schema([("ids", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("first", "terms", "ends", "df")),
                       ("height", pa.int32()), ("top", pa.int64()), ("quadrants", pa.binary()), ("steps", pa.binary())])
    path = scratch_path(docs.sparkSession, "ranked-index")
    # what is in the columns is compressed
    flat.mapInArrow(build, _INDEX).write.option("compression", "uncompressed").parquet(path)
    return Index(path, documents, terms)


def _places(block: dict, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of the wanted terms a block has, and their rows in it."""
    ends = np.concatenate([[0], _unpack(block["ends"])]).astype(np.int64)
    names = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(zstandard.decompress(block["terms"]))])
    at = pc.index_in(wanted.cast(pa.large_binary()), value_set=names)
    some = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
    return some, at.drop_null().to_numpy()


class _Tree:
    """A block's quadtree in memory, nodes from the top: for inner ones the quadrants and the first node below."""

    def __init__(self, block: dict):
        self.height = block["height"]
        self.quadrants = np.frombuffer(zstandard.decompress(block["quadrants"]), np.uint8).astype(np.int64)
        below = _BITS[self.quadrants]
        self.first = 1 + np.cumsum(below) - below
        steps = _unpack(block["steps"])
        self.value = np.empty(len(steps) + 1, np.int64)
        self.value[0] = block["top"]
        begin, end = 0, 1
        while end < len(self.value):  # the next nodes are below those from begin to end
            until = end + int(below[begin:end].sum())
            self.value[end:until] = np.repeat(self.value[begin:end], below[begin:end]) - steps[end - 1:until - 1]
            begin, end = end, until
        ids = np.array([_LAST if i is None else i for i in block["ids"]], np.int64)
        self.ids, self.copies = block["ids"], _unpack(block["first"])
        # the smallest id of a range, by depth
        least = [ids[self.copies[:-1]]]
        for _ in range(self.height):
            last = np.append(least[-1], _LAST) if len(least[-1]) % 2 else least[-1]
            least.append(np.minimum(last[::2], last[1::2]))
        self.smallest = np.concatenate(least[::-1])
        self.begin = np.cumsum([0, *(len(x) for x in least[:0:-1])])


class _Found:
    """The best documents of each of some items so far, as (-score, order, id), and what another one has to beat."""

    def __init__(self, items: int):
        self.rows: list[list[tuple[int, int, int | None]]] = [[] for _ in range(items)]
        self.score = np.full(items, 0)
        self.order = np.full(items, 0)

    def open(self, item: np.ndarray, score: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Whether documents of at most this score and at least this place in the order would be among the best."""
        least = self.score[item]
        return (score > least) | (score == least) & (order < self.order[item])

    def add(self, item: int, score: int, ids: list[int | None]) -> None:
        rows = self.rows[item]
        for i in ids[:BEST]:
            bisect.insort(rows, (-score, _LAST if i is None else i, i), key=lambda r: r[:2])
        del rows[BEST:]
        if len(rows) == BEST:
            self.score[item], self.order[item] = -rows[-1][0], rows[-1][1]


class _Waiting(NamedTuple):
    """Ranges of documents to be split: the item, the depth and place in the tree, what the score can be at most and the
    id at least, and where in a store the nodes of the item's terms are that occur in the range."""

    item: np.ndarray
    depth: np.ndarray
    place: np.ndarray
    bound: np.ndarray
    least: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def take(self, at: np.ndarray) -> _Waiting:
        return _Waiting(*(c[at] for c in self))


class _Store:
    """Nodes and their terms, one run after another."""

    def __init__(self, node: np.ndarray, term: np.ndarray):
        self.rows, self.used = np.stack([node, term]).astype(np.int32), len(node)

    def add(self, node: np.ndarray, term: np.ndarray) -> int:
        """Where the new ones begin."""
        begin, self.used = self.used, self.used + len(node)
        if self.used > self.rows.shape[1]:
            wider = np.empty((2, 2 * self.used), np.int32)
            wider[:, :begin] = self.rows[:, :begin]
            self.rows = wider
        self.rows[0, begin:self.used], self.rows[1, begin:self.used] = node, term
        return begin


def _descend(tree: _Tree, queries: list[tuple[np.ndarray, np.ndarray]], found: _Found, first: int = 0) -> int:
    """Add a block's best documents to what is found of the items from ``first`` on; returns how many ranges were split.

    A query is the rows of its terms and their weights. Of every item the ``AT_ONCE`` ranges of the highest bounds are
    split together, until none can hold a document that is better than the ones found.
    """
    size = np.array([len(r) for r, _ in queries], np.int64)
    start = np.cumsum(size) - size
    row = np.concatenate([np.zeros(0, np.int64), *(r for r, _ in queries)])
    weight = np.concatenate([np.zeros(0, np.int64), *(w for _, w in queries)])
    total = np.concatenate([[0], np.cumsum(weight)])
    zero = np.zeros(len(queries), np.int64)
    store = _Store(np.zeros(len(row), np.int64), np.arange(len(row)))
    waiting = _Waiting(np.arange(first, first + len(queries)), zero, zero, (total[start + size] - total[start]) * tree.value[0],
                       zero + tree.smallest[0], start, size)
    split = 0
    while True:
        waiting = waiting.take(np.flatnonzero(found.open(waiting.item, waiting.bound, waiting.least)))
        if not len(waiting.item):
            return split
        order = np.lexsort((waiting.least, -waiting.bound, waiting.item))
        item = waiting.item[order]
        best = np.arange(len(item)) - np.searchsorted(item, item) < AT_ONCE
        taken, waiting = waiting.take(order[best]), waiting.take(order[~best])
        split += len(taken.item)
        owner = np.repeat(np.arange(len(taken.item)), taken.length)
        at = taken.start[owner] + arrays.segments(taken.length)
        node, term = store.rows[0, at].astype(np.int64), store.rows[1, at].astype(np.int64)
        bit = row[term] >> (tree.height - 1 - taken.depth[owner]) & 1
        quadrants, below = tree.quadrants[node], tree.first[node]
        more = [waiting]
        for side in (0, 1):
            at = 2 * bit + side
            has = np.flatnonzero(quadrants >> at & 1)
            child = below[has] + _BITS[quadrants[has] & (1 << at[has]) - 1]
            own, some = owner[has], term[has]
            ends = np.searchsorted(own, np.arange(len(taken.item) + 1))
            total = np.concatenate([[0], np.cumsum(weight[some] * tree.value[child])])
            bound = total[ends[1:]] - total[ends[:-1]]
            into = np.flatnonzero(bound > 0)
            item, depth, place = taken.item[into], taken.depth[into] + 1, 2 * taken.place[into] + side
            least = tree.smallest[tree.begin[depth] + place]
            made = _Waiting(item, depth, place, bound[into], least, store.used + ends[into], ends[into + 1] - ends[into])
            made = made.take(np.flatnonzero(found.open(item, made.bound, least)))
            store.add(child, some)
            leaf = made.depth == tree.height
            more.append(made.take(np.flatnonzero(~leaf)))
            made = made.take(np.flatnonzero(leaf))
            for k in np.lexsort((made.least, -made.bound)).tolist():
                if found.open(made.item[k], made.bound[k], made.least[k]):
                    p = int(made.place[k])
                    found.add(int(made.item[k]), int(made.bound[k]), tree.ids[tree.copies[p]:tree.copies[p + 1]])
        waiting = _Waiting(*(np.concatenate(c) for c in zip(*more)))


def _blocks(spark: SparkSession, index: Index, *columns: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(index.path).select(*columns)


def _frequencies(spark: SparkSession, index: Index, wanted: list[bytes]) -> np.ndarray:
    """In how many documents each of the wanted terms is."""
    sent = spark.sparkContext.broadcast(wanted)

    def look(batches):
        terms = pa.array(sent.value, pa.binary())
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                some, row = _places(block, terms)
                total[some] += _unpack(block["df"])[row]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(at), "df": pa.array(total[at])})

    found = _blocks(spark, index, "terms", "ends", "df").mapInArrow(look, "term long, df long").groupBy("term").agg(
        F.sum("df").alias("df")).collect()
    out = np.zeros(len(wanted), np.int64)
    for r in found:
        out[r.term] = r.df
    sent.unpersist()
    return out


def _packs(items: DataFrame, id_col: str, text_col: str) -> Iterator[list]:
    """(id, its different terms) of all items, ``PACK_BYTES`` or so of terms at a time."""
    spark = items.sparkSession
    terms = F.regexp_extract_all(F.translate(text_col, CAPITALS, SMALL), F.lit(TERM), F.lit(0))
    path = scratch_path(spark, "ranked-items")
    items.select(F.col(id_col).cast("long").alias("id"), terms.alias("terms")).groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms")).where(F.size("terms") > 0).write.parquet(path)
    made = spark.read.parquet(path)
    size = made.agg(F.sum(F.octet_length(F.array_join("terms", " ")))).first()[0] or 0
    packs = -(-size // PACK_BYTES)
    for k in range(packs):
        yield made.where(F.pmod(F.xxhash64("id"), F.lit(packs)) == k).collect()


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``id_col``, rank, doc_id and score: the ``BEST`` documents of each item, or as many as have a score above 0.

    Items are taken by packs of bounded size, each of which is sent to all blocks. A task keeps its best documents of each
    item over all its blocks, so later blocks are hardly entered. Rows of an equal id, null too, are one item
    with the terms of all of them; an item without a term has no rows.
    """
    spark = items.sparkSession
    path = scratch_path(spark, "ranked-found")
    schema = "item long, doc long, score long"
    packs = 0
    for pack in _packs(items, id_col, text_col):
        wanted = sorted({t.encode() for r in pack for t in r.terms})
        place = {t: k for k, t in enumerate(wanted)}
        df = _frequencies(spark, index, wanted)
        weight = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()])
        sent = spark.sparkContext.broadcast(
            (wanted, weight, [(r.id, np.array([place[t.encode()] for t in r.terms])) for r in pack]))

        def look(batches):
            wanted, weight, asked = sent.value
            terms, found = pa.array(wanted, pa.binary()), _Found(len(asked))
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.slice(i, 1).to_pylist()[0]
                    some, rows = _places(block, terms)
                    row = np.full(len(terms), -1)
                    row[some] = rows
                    queries = []
                    for _, own in asked:
                        own = own[(row[own] >= 0) & (weight[own] > 0)]
                        queries.append((row[own], weight[own]))
                    tree = _Tree(block)
                    for first in range(0, len(queries), ITEMS):
                        _descend(tree, queries[first:first + ITEMS], found, first)
            made = [(asked[k][0], r[2], -r[0]) for k, rows in enumerate(found.rows) for r in rows]
            columns = list(zip(*made)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc", "score"])

        _blocks(spark, index, *[c.split()[0] for c in _INDEX.split(", ")]).mapInArrow(look, schema).write.parquet(
            f"{path}/{packs}")
        sent.unpersist()
        packs += 1
    found = spark.createDataFrame([], schema)
    if packs:
        found = spark.read.schema(schema).parquet(*[f"{path}/{k}" for k in range(packs)])
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST).select(
        F.col("item").alias(id_col), "rank", F.col("doc").alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The best documents of every item: ``build_index`` over ``docs`` (doc_id, text), then ``search`` for ``items``.

    Every row is indexed, and the search is exact. A null text has no terms; a document without terms is
    never found. Equal scores come by ascending id, rows without id last; repeated rows each have a rank.
    An empty table on either side gives no rows. Other columns are not looked at.
    """
    return search(build_index(docs), items)


#: The same ranking in SQL, by joins over all postings.
RANK_SQL = rf"""
WITH cut AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}') AS terms FROM documents),
sizes AS (SELECT doc_id, len(terms) AS n FROM cut WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes),
postings AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM cut) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, total GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '{TERM}')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (doc_id), total
  GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""
