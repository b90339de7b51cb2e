"""Sharding by sampled splitters: shards of nearly equal bytes that keep equal texts together.

The key of a document is a hash of its text, so copies are neighbours in the key order.  Keys are drawn
with a chance in proportion to their size; the quantiles of the sample cut the key order into many ranges
of about equal bytes.  All rows are then counted per range.  A range that turns out overfull is cut again,
at quantiles of its own keys; a single text that fills more than a shard's part is cut by a hash of the id.
The ranges, at most a few thousand, are dealt to the shards, largest first.

The sample only places the cuts: every size and count that decides is taken over all rows.  ``slot`` numbers
the rows of a shard without a gap; it is counted in small cells of a range and a running sum of the cells'
counts, so no task sorts a shard.

Cases: a null text has size 1 and the key of the empty text.  Rows that repeat an id are rows of their own.
Rows with equal keys are ordered by id; rows with a null id come first.  A table with fewer rows than shards
leaves shards empty; an empty table gives an empty result.  Only id and text are read.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeglass.llm.common import longs, stage, text_or_empty, unit_hash

RANGES_PER_SHARD = 64
# Draws of the size-weighted sample per range.  More only moves the cuts closer to the exact quantiles.
DRAWS_PER_RANGE = 64
# Rows that one task numbers at most.
CELL_ROWS = 1_000_000
CELLS = 1024
# A shard may be larger than the mean by this part before large groups are cut finer.
TOLERANCE = 0.02
_LAST = (1 << 63) - 1


def shard(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranges_per_shard: int = RANGES_PER_SHARD,
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null: this law moves rows when a
    shard is added)."""
    text = text_or_empty(text_col)
    rows = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            # 48 bits: quantiles are computed in doubles, which hold such keys exactly.
            F.shiftrightunsigned(F.xxhash64(text), 16).alias("key"),
        ),
        "shard-rows",
    )
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    ranges = shards * ranges_per_shard
    target = (total or 0) / ranges
    ranged, stats = _ranges(rows, total or 1, ranges)
    limit = (total or 0) / shards
    while True:
        pieces = _cut(stats, target, limit)
        placed = ranged.withColumn("piece", _piece(pieces))
        sizes = {r["piece"]: (r["bytes"], r["n"]) for r in _sizes(placed, "piece").collect()}
        of_piece, fullest = _deal(sizes, len(sizes) and max(sizes) + 1, shards)
        if fullest <= (1 + TOLERANCE) * (total or 0) / shards or limit <= target:
            break
        limit /= 2
    cell_rows = min(CELL_ROWS, max(1, math.ceil((count or 1) / CELLS)))
    cells = [max(1, math.ceil(sizes.get(p, (0, 0))[1] / cell_rows)) for p in range(len(of_piece))]
    return _numbered(placed, of_piece, cells)


def write_shards(docs: DataFrame, path: str, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents with their columns into one folder per shard."""
    places = shard(docs, shards, id_col, text_col).select(
        F.col("doc_id").alias("_of"), F.col("shard").alias("_shard")
    ).dropDuplicates(["_of"])
    docs.join(places, docs[id_col].eqNullSafe(F.col("_of"))).drop("_of").withColumnRenamed("_shard", "shard_id").write.partitionBy(
        "shard_id"
    ).parquet(path)


def _sizes(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(by).agg(
        F.sum("size").alias("bytes"),
        F.count(F.lit(1)).alias("n"),
        F.min("key").alias("low"),
        F.max("key").alias("high"),
    )


def _quantiles(rows: DataFrame, draws: Column, parts: int) -> list[int]:
    """Keys that cut the rows into parts of about equal bytes; a heavy key comes several times."""
    drawn = rows.select("key", F.explode(F.sequence(F.lit(1), draws)).alias("draw")) if parts > 1 else rows.limit(0)
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    return drawn.agg(F.percentile_approx("key", at, 1_000_000).alias("cuts")).first()["cuts"] or []


def _draws(per_byte: float) -> Column:
    """How often a row is drawn: its expected number, rounded up or down by a hash of its id."""
    n = F.floor(F.col("size") * F.lit(per_byte) + unit_hash(F.col("doc_id"), 1)).cast("int")
    return F.when(n > 0, n)


def _splitters(cuts: list[int]) -> list[int]:
    """Sorted, once each; a key that fills a whole part gets a range of its own."""
    heavy = {a for a, b in zip(cuts, cuts[1:], strict=False) if a == b}
    return sorted({*cuts, *(k + 1 for k in heavy)})


def _range_of(splitters: list[int]) -> Column:
    """How many splitters are at or below the key, by binary search in the array."""
    steps = [1 << i for i in reversed(range(max(1, len(splitters).bit_length())))]
    table = longs(splitters + [_LAST] * (2 * steps[0] - len(splitters)))
    return F.aggregate(
        F.lit(steps).cast("array<int>"),
        F.lit(0),
        lambda at, step: F.when(F.get(table, at + step - 1) <= F.col("key"), at + step).otherwise(at),
    )


def _ranges(rows: DataFrame, total: int, ranges: int) -> tuple[DataFrame, list]:
    """The rows with their range, and per range its bytes, rows and keys.  Overfull ranges of more than one
    key are cut again, in proportion to their bytes."""
    splitters = _splitters(_quantiles(rows, _draws(ranges * DRAWS_PER_RANGE / total), ranges))
    for _ in range(3):
        ranged = rows.withColumn("range", _range_of(splitters))
        stats = _sizes(ranged, "range").orderBy("range").collect()
        overfull = [r for r in stats if r["bytes"] > 2 * total / ranges and r["low"] < r["high"]]
        if not overfull:
            break
        more: list[int] = []
        # One pass for all overfull ranges; each has a bounded sample of its own.
        parts = {r["range"]: math.ceil(r["bytes"] * ranges / total) for r in overfull}
        drawn = (
            ranged.filter(F.col("range").isin(list(parts)))
            .select("range", "key", F.explode(F.sequence(F.lit(1), _draws(8 * ranges * DRAWS_PER_RANGE / total))).alias("draw"))
            .groupBy("range")
            .agg(F.percentile_approx("key", [i / 32 for i in range(1, 32)], 1_000_000).alias("cuts"))
        )
        for r in drawn.collect():
            more += _splitters(r["cuts"] or [])
        more += [r["low"] + 1 for r in overfull]
        splitters = sorted({*splitters, *more})
    ranged = rows.withColumn("range", _range_of(splitters))
    return ranged, _sizes(ranged, "range").orderBy("range").collect()


def _cut(stats: list, target: float, limit: float) -> tuple[list[int], list[int]]:
    """Per range its first piece and its number of pieces.  Only a range beyond the limit has more than one."""
    first, parts, at = [], [], 0
    by_range = {r["range"]: r["bytes"] for r in stats}
    for index in range(max(by_range, default=0) + 1):
        size = by_range.get(index, 0)
        n = math.ceil(size / target) if size > max(limit, target) else 1
        first.append(at)
        parts.append(n)
        at += n
    return first, parts


def _piece(pieces: tuple[list[int], list[int]]) -> Column:
    first, parts = (longs(x) for x in pieces)
    return F.get(first, F.col("range")) + F.pmod(F.xxhash64("doc_id", F.lit(2)), F.get(parts, F.col("range")))


def _deal(sizes: dict[int, tuple[int, int]], pieces: int, shards: int) -> tuple[list[int], int]:
    """Each piece's shard, the largest piece first to the emptiest shard; and the bytes of the fullest shard."""
    heap = [(0, s) for s in range(shards)]
    of_piece = [0] * max(1, pieces)
    for piece, (size, _) in sorted(sizes.items(), key=lambda x: (-x[1][0], x[0])):
        filled, s = heapq.heappop(heap)
        of_piece[piece] = s
        heapq.heappush(heap, (filled + size, s))
    return of_piece, max(heap)[0]


def _numbered(placed: DataFrame, of_piece: list[int], cells: list[int]) -> DataFrame:
    rows = placed.select(
        "*",
        F.get(longs(of_piece), F.col("piece")).cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.get(longs(cells), F.col("piece"))).alias("cell"),
    )
    before = Window.partitionBy("shard").orderBy("piece", "cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("shard", "piece", "cell").agg(F.count(F.lit(1)).alias("n"))
    starts = stage(
        counts.select("piece", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "shard-cells"
    )
    inside = Window.partitionBy("piece", "cell").orderBy("key", "doc_id")
    return (
        rows.join(starts, ["piece", "cell"])
        .withColumn("slot", F.col("start") + F.row_number().over(inside) - 1)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            "slot",
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
