"""Connected components of a graph of any size, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeglass.llm.common import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """From links (a bigint, b bigint): each linked node with the smallest node that it reaches, as (node,
    root), the root itself included.  Loops and repeated links do no harm; no links give no rows.

    Each step points the neighbours of a node at the smallest of them, so paths shrink to stars in about
    log(n) rounds.  A node's neighbours are never gathered: the smallest comes from partial
    aggregation, and is joined back to the links, where Spark splits a hub's partition.
    """
    links = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = stage(links.distinct(), name)
    seen = _sign(links)
    while seen[0]:
        both = links.union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(small.union(low).distinct(), name)
        now = _sign(links)
        if now == seen:
            break
        seen = now
    roots = links.select("v").distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))


def _sign(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]
