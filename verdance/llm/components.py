"""Connected components of a link table, without gathering links on one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import discard, materialize

#: Links from which a node is a hub.
HUB = 65_536


def _least(rows: DataFrame, least: DataFrame, key: str, hub: int) -> DataFrame:
    """rows with the `m` that least(key, m, n) has for their key. Hubs, of which there are at most len(rows) / hub, are broadcast, so their rows stay spread."""
    hubs = least.where(F.col("n") > hub).select(key, F.col("m").alias("hm"))
    met = rows.join(F.broadcast(hubs), key, "left")
    usual = met.where("hm is null").drop("hm").join(least.where(F.col("n") <= hub).select(key, "m"), key)
    return met.where("hm is not null").withColumnRenamed("hm", "m").select(usual.columns).unionByName(usual)


def components(links: DataFrame, hub: int = HUB) -> DataFrame:
    """(node, root) for every node of links(u, v); root is the smallest node of its component.

    Large-star and small-star steps in turn: every node hangs its larger, then its
    smaller neighbours on the smallest of them, until nothing changes. Each round is
    two aggregations and two joins of the links; a round's table goes when the next is written.
    """
    e = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "links")
    seen = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
        seen = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = _least(e, least.withColumnRenamed("u", "v"), "v", hub).select("u", F.col("m").alias("v")).where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        hung = _least(large, small, "u", hub).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        before, e = e, materialize(hung.unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(before)
