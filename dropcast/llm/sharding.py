"""Sharding by longest processing time: groups that stay together, largest first, to the least-loaded shard."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, grouped_rank

ITEMS_PER_SHARD = 512


def longest_first(sizes: list[tuple[str, int]], n_shards: int) -> dict[str, int]:
    """Items (name, size), largest first (ties by name), each to the shard with the least load (ties: lowest number)."""
    load = [(0, s) for s in range(n_shards)]
    where = {}
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        total, shard = load[0]
        where[name] = shard
        heapq.heapreplace(load, (total + size, shard))
    return where


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
          row_bytes: int = 8, items_per_shard: int = ITEMS_PER_SHARD) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) of every row, by the law ``bytes``.

    Size: UTF-8 bytes of the text (null: none) plus ``row_bytes``. Rows with equal texts (null counts as
    empty) share a shard. A group above 1/items_per_shard of a mean shard is an item of its own (there are
    at most ``n_shards * items_per_shard``); the smaller groups are dealt by hash into that many bundles.
    So the driver's heap sees at most ``2 * n_shards * items_per_shard`` items at any input size, largest
    first. Only a group larger than a mean shard can make a shard stand out. ``slot`` numbers a shard's rows
    from 0 without gaps, by hash order; rows with equal id and text are interchangeable. An empty table
    gives an empty result; null ids are kept.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = cut(docs.select(
        F.col(id_col), (F.octet_length(text) + row_bytes).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit("second"), text).alias("_h2")), "sharding-rows")
    group = ["_h1", "_h2", "text_crc32"]
    groups = rows.groupBy(*group).agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    n_items = n_shards * items_per_shard
    bundle = F.pmod(F.col("_h2"), F.lit(n_items))
    own = F.col("bytes") * n_items >= F.lit(total)
    named = groups.withColumn("large", own).withColumn("name", F.when(own, F.concat_ws(":", *group)).otherwise(bundle.cast("string")))
    items = named.groupBy("name", "large").agg(F.sum("bytes").alias("bytes")).collect()  # at most 2 * n_items rows
    where = longest_first([(r["name"], r["bytes"]) for r in items], n_shards)
    spark = docs.sparkSession
    placed = spark.createDataFrame([(r["name"], r["large"], where[r["name"]]) for r in items], "name string, large boolean, shard int")
    large = placed.where("large").select(F.col("name").alias("_own"), F.col("shard").alias("_own_shard"))
    small = placed.where("not large").select(F.col("name").alias("_bundle"), F.col("shard").alias("_bundle_shard"))
    # both tables have at most n_items rows of a few dozen bytes
    dealt = (rows.withColumn("_own", F.concat_ws(":", *group)).withColumn("_bundle", bundle.cast("string"))
             .join(F.broadcast(large), "_own", "left").join(F.broadcast(small), "_bundle", "left")
             .withColumn("shard", F.coalesce("_own_shard", "_bundle_shard")))
    ranked = grouped_rank(dealt.select(id_col, "size", "text_crc32", "shard", "_h1", "_h2"), "shard", [id_col, "_h1", "_h2"], "slot")
    return ranked.select(id_col, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
