"""Sharding by largest differencing: shards of near equal bytes, copies of a text kept together.

A partial partition is a tuple of one sum for each shard. It starts as one group of
equal texts in one place and nothing in the others. The two tuples with the largest spread are
combined, the largest sum of one with the smallest of the other, until one is left.
Groups are dealt into buckets, each bucket is combined to one tuple in one task, and the
buckets' tuples are the items of the next level, until one bucket holds them all. No task
holds more than about ``bucket`` items, whatever the number of documents.

Defined cases: null texts are one group, of size 1 a row; an empty text is another; a group
larger than a shard's share stays whole, so its shard is then larger; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def difference(items: list[tuple[int, ...]], shards: int) -> tuple[tuple[int, ...], list[tuple[int, ...]]]:
    """Combine tuples of sums to one; also each item's map from its own place to the final one."""
    nodes = list(items)
    parts: list[tuple | None] = [None] * len(items)
    heap = [(min(t) - max(t), i) for i, t in enumerate(nodes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        high = sorted(range(shards), key=nodes[a].__getitem__, reverse=True)
        low = sorted(range(shards), key=nodes[b].__getitem__)
        made = tuple(nodes[a][x] + nodes[b][y] for x, y in zip(high, low))
        nodes.append(made)
        parts.append((a, high, b, low))
        nodes[a] = nodes[b] = ()
        heapq.heappush(heap, (min(made) - max(made), len(nodes) - 1))
    maps: list[tuple[int, ...]] = [()] * len(nodes)
    maps[-1] = tuple(range(shards))
    for k in range(len(nodes) - 1, len(items) - 1, -1):
        a, high, b, low = parts[k]
        for child, order in ((a, high), (b, low)):
            to = [0] * shards
            for place, own in enumerate(order):
                to[own] = maps[k][place]
            maps[child] = tuple(to)
        maps[k] = ()
    return nodes[-1], maps[: len(items)]


def _level(items: DataFrame, shards: int) -> DataFrame:
    """``item, sums, bucket`` to ``item, bucket, places`` and, on one row a bucket, its ``total``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item", kind="stable")
        total, maps = difference([tuple(map(int, s)) for s in group["sums"]], shards)
        totals = [list(total)] + [None] * (len(group) - 1)
        return pd.DataFrame({"item": group["item"].array, "bucket": group["bucket"].array, "places": [list(m) for m in maps], "total": totals})

    return cut_lineage(items.groupBy("bucket").applyInPandas(run, "item string, bucket bigint, places array<int>, total array<bigint>"))


def assign(groups: DataFrame, shards: int = 8, bucket: int = 20_000) -> DataFrame:
    """``item`` (string key) and ``size`` of indivisible groups to ``item, shard``."""
    sums = F.concat(F.array(F.col("size").cast("bigint")), F.array_repeat(F.lit(0).cast("bigint"), shards - 1))
    items = groups.select("item", sums.alias("sums"))
    levels = []
    n = items.count()
    while n:
        n = -(-n // bucket)
        level = _level(items.withColumn("bucket", F.pmod(F.xxhash64("item", F.lit(len(levels))), F.lit(n))), shards)
        levels.append(level)
        if n == 1:
            break
        items = level.where(F.col("total").isNotNull()).select(F.concat_ws(":", F.lit(len(levels)), "bucket").alias("item"), F.col("total").alias("sums"))
        n = items.count()  # a bucket may be empty
    if not levels:
        return groups.select("item", F.lit(0).alias("shard"))
    to = levels[-1].select("item", "places")
    for depth in range(len(levels) - 1, 0, -1):
        below = levels[depth - 1].withColumn("_up", F.concat_ws(":", F.lit(depth), "bucket")).select("item", "places", "_up")
        above = to.select(F.col("item").alias("_up"), F.col("places").alias("_to"))
        composed = F.transform("places", lambda p: F.element_at("_to", p + 1))
        to = below.join(above, "_up").select("item", composed.alias("places"))
    return to.select("item", F.element_at("places", 1).cast("int").alias("shard"))


def shard(docs: DataFrame, shards: int = 8, bucket: int = 20_000, spread: int = 256) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``.

    Slots count each shard's rows from 0 without gaps. Rows are numbered within
    ``shards * spread`` pieces, dealt by a hash of id and text, and a piece starts after those before it.
    """
    raw = F.col("text").cast("binary")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 1
    key = F.coalesce(F.sha2(raw, 256), F.lit("null"))
    rows = cut_lineage(docs.select("doc_id", size.alias("size"), F.coalesce(F.crc32(raw), F.lit(0)).cast("bigint").alias("text_crc32"), key.alias("item")))
    to = assign(rows.groupBy("item").agg(F.sum("size").alias("size")), shards, bucket)
    placed = rows.join(to, "item").withColumn("_piece", F.pmod(F.xxhash64("doc_id", "item"), F.lit(spread)))
    counts = placed.groupBy("shard", "_piece").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(counts.select("shard", "_piece", F.coalesce(before, F.lit(0)).alias("_before")))  # shards * spread rows
    within = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("doc_id", "item")) - 1
    return placed.withColumn("_within", within).join(starts, ["shard", "_piece"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_within")).cast("bigint").alias("slot")
    )
