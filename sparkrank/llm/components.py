"""Connected components of a link table by alternating large and small stars.

Every round is a partial-aggregated ``min`` per node and an equi-join; nothing is gathered
per node, so a hub with very many neighbours is split by the adaptive skew join. Links beyond
a counted number are joined by a merge, never through the driver. Each round is written to the
shared folder, which keeps plans short and survives lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, merged_if_large

MAX_ROUNDS = 60


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; ``component`` is the smallest node
    reachable. Loops and repeated links are harmless; a node without a link to another node
    and rows with a null end are absent; an empty input gives an empty result.
    """
    e = cut(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    before, n = None, e.count()
    for _ in range(MAX_ROUNDS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(merged_if_large(low, 2 * n), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(merged_if_large(low2, 2 * n), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(low2.withColumnRenamed("m", "v")).distinct(), "stars")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, n = now, now[0]
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
