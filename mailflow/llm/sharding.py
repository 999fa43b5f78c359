"""Dealing groups of documents to shards of equal bytes."""

from __future__ import annotations

import heapq
from itertools import count

import numpy as np
from pyspark.sql import DataFrame, functions as F

from mailflow.llm.ranks import numbered
from mailflow.llm.store import stored

PER_SHARD = 256  # bundles of small groups, and at most as many single large groups


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item by Karmarkar-Karp differencing: the two partial partitions
    with the largest spread are combined, the largest part of one with the smallest of
    the other, until one is left."""
    tie = count()
    heap = []
    for i, size in enumerate(sizes):
        parts = np.zeros(shards, dtype=object if size > 2**60 else np.int64)
        parts[0] = size
        heap.append((-size, next(tie), parts, [[i]] + [[] for _ in range(shards - 1)]))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, held = heapq.heappop(heap)
        _, _, b, more = heapq.heappop(heap)
        total = a + b[::-1]
        order = np.argsort(-total, kind="stable")
        lists = []
        for j in order:
            x, y = held[j], more[shards - 1 - j]
            if len(x) < len(y):
                x, y = y, x
            x.extend(y)
            lists.append(x)
        total = total[order] - total[order[-1]]
        heapq.heappush(heap, (-int(total[0]), next(tie), total, lists))
    place = [0] * len(sizes)
    if heap:
        for shard, items in enumerate(heap[0][3]):
            for i in items:
                place[i] = shard
    return place


def shards(rows: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Deal documents to ``n`` shards of nearly equal bytes; equal texts stay together.

    A group is all rows with one text.  Groups above a bundle's share of all bytes (there
    are at most ``256 * n``) are items by themselves, all others go to ``256 * n`` bundles
    by a hash of the text.  The bytes of the items, a table of bounded size, are all that
    the differencing sees; which shard an item got is a bounded table too and is broadcast.

    Returns doc_id, size (UTF-8 bytes plus 8; a null text has no bytes and is grouped with
    empty ones), text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard
    (null: the law is ``bytes``).  Null and repeated keys are dealt like others; a shard
    may be empty.  Other columns of ``rows`` are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = stored(
        rows.select(
            F.col(key).cast("long").alias("doc_id"), (F.octet_length(body) + 8).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2"),
        ), "sized",
    )
    spark, bundles = rows.sparkSession, PER_SHARD * n
    groups = base.groupBy("h1", "h2").agg(F.sum("size").alias("bytes"))
    total, number = base.agg(F.sum("size"), F.count("*")).first()
    large = groups.where(F.col("bytes") > (total or 0) / bundles).collect()
    single = spark.createDataFrame(
        [(r.h1, r.h2, bundles + i) for i, r in enumerate(sorted(large))], "h1 long, h2 long, own int"
    )
    item = F.coalesce("own", F.pmod("h1", F.lit(bundles)).cast("int"))
    dealt = base.join(F.broadcast(single), ["h1", "h2"], "left").select("doc_id", "size", "text_crc32", "h1", item.alias("item"))
    sums = sorted((r[0], r[1]) for r in dealt.groupBy("item").agg(F.sum("size")).collect())
    placed = difference([s for _, s in sums], n)
    where = spark.createDataFrame([(i, s) for (i, _), s in zip(sums, placed, strict=True)], "item int, shard int")
    out = dealt.join(F.broadcast(where), "item")
    out = numbered(out, ["shard"], ["doc_id", "h1", "size"], number)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
