"""All pairs of 64-bit fingerprints that differ in a few bits, by pigeonhole blocks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeglass.llm.common import stage

# Fingerprints of one bucket that are compared with each other.  Larger buckets go the way of centres.
BUCKET = 32


def masks(blocks: int, bits: int) -> list[int]:
    """Bit masks of all choices of blocks - bits blocks.  Fingerprints that differ in at most ``bits`` bits
    are equal in at least that many blocks, so under at least one of the masks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    spans = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(spans, blocks - bits)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_pairs(prints: DataFrame, bits: int = 2, blocks: int = 5, name: str = "hamming") -> DataFrame:
    """From distinct fingerprints (fp bigint): every pair (a, b), a < b, that differs in at most ``bits`` bits.

    Each fingerprint goes to one bucket per mask.  Buckets of up to ``BUCKET`` fingerprints are joined with
    themselves and the distance is verified.  The fingerprints of fuller buckets would make pairs with the
    square of their number; for them, and two bits at most, the pairs are found through centres: two
    fingerprints differ in at most two bits just if flipping at most one bit in each can make them equal.
    A centre has at most 65 fingerprints, so this stays in proportion to the pairs that are there.
    """
    if bits > 2:
        raise ValueError("full buckets are solved for two differing bits at most")
    table = F.array(
        *[
            F.struct(F.lit(i).cast("tinyint").alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("block"))
            for i, m in enumerate(masks(blocks, bits))
        ]
    )
    rows = prints.select("fp", F.explode(table).alias("t")).select("fp", "t.mask", "t.block")
    full = rows.groupBy("mask", "block").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage(rows.join(full, ["mask", "block"]), f"{name}-blocks")
    light = shared.filter(F.col("n") <= BUCKET).select("mask", "block", "fp")
    other = light.withColumnRenamed("fp", "b")
    joined = (
        light.withColumnRenamed("fp", "a")
        .join(other, ["mask", "block"])
        .filter((F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= bits))
        .select("a", "b")
    )
    crowded = shared.filter(F.col("n") > BUCKET).select("fp").distinct()
    centres = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    around = (
        crowded.select("fp", F.explode(centres).alias("centre"))
        .groupBy("centre")
        .agg(F.collect_set("fp").alias("near"))
        .filter(F.size("near") > 1)
    )
    met = around.select(F.explode("near").alias("a"), "near").select("a", F.explode("near").alias("b"))
    met = met.filter((F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= bits))
    return joined.union(met).distinct()
