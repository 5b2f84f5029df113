"""Sharding by longest-processing-time scheduling.

Rows with equal texts form a group that must stay together. Groups, largest first, go
to the least loaded shard, through a heap. A heap over all groups of a large corpus
would be one long task, so the scheduled items are bounded in number:

* a group of more than ``total / (shards * GRAIN)`` bytes is an item of its own. By
  that size there can be at most ``shards * GRAIN`` of them;
* all other groups are dealt by a hash of their text into ``shards * GRAIN`` bundles,
  and each bundle is an item.

So the heap sees at most ``2 * shards * GRAIN`` items whatever the corpus, and an
item that is no large group weighs about 1 / GRAIN of a shard. Shards come out nearly
equal, except where one group alone outweighs a shard's share.

A row's item follows from its own text and the bounded list of large groups, so rows
are not shuffled to be assigned; they are written with their shard and a place of their
own. Slots number the rows of a shard: rows are dealt by a hash of their place into
buckets, buckets get consecutive ranges of slots, and only within a bucket are rows counted
one by one. Since places differ, a million copies of one row are dealt out evenly, too.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.frames import lanes, stored

#: Scheduled items per shard, at most twice.
GRAIN = 500
#: Added to the bytes of each row's text.
OVERHEAD = 8


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus OVERHEAD."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD


def schedule(items: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """Longest-processing-time: items by falling size to the least loaded shard.

    Equal sizes are taken in order of their names, equal loads by shard number.
    """
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for name, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def _bundle(group: Column, bundles: int) -> Column:
    return F.concat(F.lit("#"), F.pmod(F.xxhash64(group), F.lit(bundles)).cast("string"))


def shard_by_size(
    docs: DataFrame, shards: int = 24, text: str = "text"
) -> DataFrame:
    """Every row as struct ``row``, with ``size``, ``shard`` (int) and ``slot`` (long).

    Rows with equal texts are in one shard; a null text equals an empty one. Slots
    count the rows of a shard from 0 without gaps; repeated rows have slots of their
    own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        row_size(docs[text]).alias("size"),
        F.md5(body).alias("group"),
    )
    bundles = shards * GRAIN
    sizes = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    items = (
        sizes.withColumn("large", F.col("bytes") * bundles > total)
        .groupBy(
            F.when(F.col("large"), F.col("group")).otherwise(_bundle(F.col("group"), bundles))
            .alias("item")
        )
        .agg(F.sum("bytes").alias("bytes"))
    )
    # At most 2 * bundles rows: see above.
    placed = schedule([tuple(x) for x in items.collect()], shards)
    table = spark.createDataFrame(list(placed.items()), "item string, shard int")
    large = table.where(~F.col("item").startswith("#")).select(
        F.col("item").alias("group"), F.col("shard").alias("own_shard")
    )
    small = table.where(F.col("item").startswith("#"))
    assigned = (
        rows.join(F.broadcast(large), "group", "left")
        .withColumn("item", _bundle(F.col("group"), bundles))
        .join(F.broadcast(small), "item", "left")
        .select(
            "row", "size", F.coalesce("own_shard", "shard").alias("shard"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    # Once written, places no longer change, however often a task is run again.
    return _slotted(stored(assigned))


def _slotted(assigned: DataFrame) -> DataFrame:
    """Slots from 0 in each shard, without sorting a shard in one task."""
    buckets = 8 * lanes(assigned.sparkSession)
    dealt = assigned.withColumn("bucket", F.pmod(F.xxhash64("place"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    # shards * buckets rows at most, one window of `buckets` rows for each shard.
    before = Window.partitionBy("shard").orderBy("bucket")
    offsets = counts.select(
        "shard", "bucket", (F.sum("n").over(before) - F.col("n")).alias("offset")
    )
    inside = Window.partitionBy("shard", "bucket").orderBy("place")
    numbered = dealt.withColumn("at", F.row_number().over(inside).cast("bigint") - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "bucket"]).select(
        "row", "size", "shard", (F.col("offset") + F.col("at")).alias("slot")
    )
