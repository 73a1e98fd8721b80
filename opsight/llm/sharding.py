"""Byte-balanced shards by Karmarkar-Karp differencing of indivisible groups."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from opsight.session import cut_lineage, scratch_path

#: Groups that one task differences; their partial partitions are differenced in the next round.
BUCKET_GROUPS = 20_000
#: Partial partitions that one task differences.
FAN = 4096
#: Rows numbered together.
CHUNK_ROWS = 100_000


def difference(sizes: np.ndarray) -> np.ndarray:
    """Karmarkar-Karp over partial partitions: ``sizes[i, j]`` is the size of part j of item i.

    The two partial partitions of largest spread are combined, the largest parts of one with the smallest of
    the other, until one is left. Returns the final part of each part of each item.
    """
    n, k = sizes.shape
    order = np.argsort(-sizes, axis=1, kind="stable")
    parts = np.take_along_axis(sizes, order, 1).tolist()
    heap = [(p[-1] - p[0], i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        joined = [x + y for x, y in zip(parts[a], reversed(parts[b]))]
        turn = sorted(range(k), key=joined.__getitem__, reverse=True)
        merges.append((a, b, turn))
        parts.append([joined[j] for j in turn])
        parts[a] = parts[b] = None
        heapq.heappush(heap, (parts[-1][-1] - parts[-1][0], len(parts) - 1))
    places: list = [None] * len(parts)
    if parts:
        places[-1] = list(range(k))
    for node in range(len(merges) - 1, -1, -1):
        a, b, turn = merges[node]
        mine, before = places[n + node], [0] * k
        for p, j in enumerate(turn):
            before[j] = mine[p]
        places[a], places[b] = before, before[::-1]
    final = np.empty((n, k), np.int64)
    if n:
        np.put_along_axis(final, order, np.array(places[:n], np.int64), 1)
    return final


def _place_groups(k: int):
    def place(bucket: pa.Table) -> pa.Table:
        sizes = np.zeros((bucket.num_rows, k), np.int64)
        sizes[:, 0] = bucket.column("size").to_numpy()
        return pa.table({"bucket": bucket.column("bucket"), "key": bucket.column("key"), "size": bucket.column("size"),
                         "part": pa.array(difference(sizes)[:, 0].astype(np.int32))})

    return place


def _place_parts(k: int):
    def place(above: pa.Table) -> pa.Table:
        names, row = np.unique(above.column("bucket").to_numpy(), return_inverse=True)
        sizes = np.zeros((len(names), k), np.int64)
        sizes[row, above.column("part").to_numpy()] = above.column("size").to_numpy()
        final = difference(sizes)
        return pa.table({
            "bucket": pa.array(np.repeat(names, k)), "part": pa.array(np.tile(np.arange(k, dtype=np.int32), len(names))),
            "above": pa.array(np.repeat(names // FAN, k)), "above_part": pa.array(final.ravel().astype(np.int32)),
            "size": pa.array(sizes.ravel()),
        })

    return place


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``key`` and ``shard`` of groups (key, size), by rounds of differencing.

    A bounded number of groups is differenced by each task, then the resulting partial partitions, until
    one task holds the last few; a round leaves one partial partition of thousands.
    """
    groups = cut_lineage(groups)
    buckets = max(1, -(-groups.count() // BUCKET_GROUPS))
    spread = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets).cast("long")))
    placed = cut_lineage(spread.groupBy("bucket").applyInArrow(
        _place_groups(shards), "bucket long, key binary, size long, part int"))
    parts = placed.groupBy("bucket", "part").agg(F.sum("size").alias("size"))
    placed = placed.drop("size")
    while buckets > 1:
        up = cut_lineage(parts.withColumn("group", F.floor(F.col("bucket") / FAN)).groupBy("group").applyInArrow(
            _place_parts(shards), "bucket long, part int, above long, above_part int, size long"))
        placed = placed.join(up.drop("size"), ["bucket", "part"]).select(
            F.col("above").alias("bucket"), F.col("above_part").alias("part"), "key")
        parts = up.groupBy(F.col("above").alias("bucket"), F.col("above_part").alias("part")).agg(
            F.sum("size").alias("size"))
        buckets = -(-buckets // FAN)
    return placed.select("key", F.col("part").alias("shard"))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's shard, 0 to ``shards`` - 1, so that the shards' bytes are near equal.

    Returns ``id_col``, size (UTF-8 bytes and 1), text_crc32, law (``bytes``), shard, slot (gapless from 0 in
    each shard) and grown_shard (null under this law). Rows of equal texts are one indivisible group; the groups
    are balanced by Karmarkar-Karp differencing, so a group of more than its share makes its shard larger. A
    null text has no bytes, and all null texts are a group; repeated rows and null ids are placed like others;
    an empty table gives no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    path = scratch_path(spark, "sizes")
    docs.select(
        F.col(id_col).cast("long").alias("id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.unhex(F.lit("00"))).alias("key"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    where = assign_groups(rows.groupBy("key").agg(F.sum("size").alias("size")), shards)
    chunks = max(1, -(-rows.count() // CHUNK_ROWS))
    path = scratch_path(spark, "shards")
    rows.join(where, "key").withColumn(
        "chunk", F.pmod(F.xxhash64("id", "text_crc32"), F.lit(chunks).cast("long"))).drop("key").write.parquet(path)
    placed = spark.read.parquet(path)
    counts = spark.read.parquet(path).groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("id", "text_crc32"))
    return placed.withColumn("turn", inside).join(bases, ["shard", "chunk"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("base") + F.col("turn") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
