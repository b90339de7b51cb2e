"""Importance resampling: draw the documents that are likeliest under a target's word n-grams.

Words are runs of ASCII letters and digits and of all other characters from U+0080 on, A-Z in lower case.  Features are
all runs of one to three consecutive words, joined by blanks, hashed to buckets.  A bucket gains by how much
likelier the target's texts are to hold it than the corpus is; a document's weight is the sum over its
features, and the draw adds Gumbel noise made from the id (the highest sums are a draw without replacement).

Line ends part texts into lines, and many lines come again and again.  The features within a line are counted once for
each distinct line: its count times its occurrences goes into the corpus, its gain into every document that has it.
Features that cross line ends are made per document from the two words on either side, and added apart.

A line that makes up a 4,096th of all lines or more is looked up in a broadcast of at most so many rows; the rest
is joined, so no key has more than that share.  Ranks come from a range-partitioned sort and the number of rows
of each range; nothing is sorted in one task.

Cases: a null or empty text has no features and weight 0; a null id counts as empty text in the noise and
comes last among ties.  Rows that repeat an id are weighed and drawn each.  An empty target gains by its add-one
counts alone.  A very long line is one feature list in memory, some 150 bytes a word.  Only id and text
are read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeglass.llm.common import longs, stage

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
# A line with at least one of so many occurrences is frequent; there are at most as many.
FREQUENT = 4_096
# A to Z become lower case, every other ASCII character that is no letter or digit parts words.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 10 if b == 10 else 32 for b in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def line_buckets(line: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The buckets of all features within a line, repeats included."""
    ones = list(map(crc32, line))
    after = [b" " + word for word in line[1:]]
    twos = list(map(crc32, after, ones))
    threes = list(map(crc32, after[1:], twos))
    return (np.array(ones + twos + threes, dtype=np.uint32) % buckets).astype(np.uint16)


def crossing_buckets(lines: list[list[bytes]], buckets: int = BUCKETS) -> list[int]:
    """The buckets of the features that cross a line end; lines without words do not count."""
    found: list[int] = []
    held: list[bytes] = []
    for line in lines:
        if not line:
            continue
        head = line[:2]
        if held:
            near = held[-2:]
            found.append(crc32(near[-1] + b" " + head[0]))
            if len(near) == 2:
                found.append(crc32(b" ".join((*near, head[0]))))
            if len(head) == 2:
                found.append(crc32(b" ".join((near[-1], *head))))
        held = line[-2:] if len(line) > 1 else [*held[-1:], *line]
    return [value % buckets for value in found]


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line != "")


def _key(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _distinct_lines(texts: DataFrame, buckets: int) -> DataFrame:
    """(key, n, features, buckets): every distinct line, its occurrences and the buckets of its features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [line_buckets(words(line), buckets) for line in batch.column(2).to_pylist()]
            columns = [pa.array(list(map(len, made)), pa.int64()), pa.array([m.tobytes() for m in made], pa.binary())]
            yield pa.record_batch([*batch.columns[:2], *columns], names=["key", "n", "features", "buckets"])

    counted = texts.select(F.explode(_lines(F.col("text"))).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select(_key(F.col("line")).alias("key"), "n", F.col("line").cast("binary").alias("line"))
    return stage(rows.mapInArrow(run, "key binary, n bigint, features bigint, buckets binary"), "resampling-lines")


def _documents(texts: DataFrame, buckets: int) -> DataFrame:
    """(row, doc_id, words, crossing, keys): a number for each row, its words, the buckets of the features that
    cross line ends, and the keys of its lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, crossing = [], []
            for text in batch.column(2).to_pylist():
                lines = [line.split() for line in (text or b"").translate(_FOLD).split(b"\n")]
                sizes.append(sum(map(len, lines)))
                crossing.append(np.array(crossing_buckets(lines, buckets), dtype=np.uint16).tobytes())
            columns = [pa.array(sizes, pa.int64()), pa.array(crossing, pa.binary())]
            yield pa.record_batch([*batch.columns[:2], *columns, batch.column(3)], names=[f.name for f in schema])

    keys = F.transform(_lines(F.col("text")), _key)
    empty = F.array().cast("array<binary>")
    rows = texts.select("doc_id", F.col("text").cast("binary").alias("text"), F.coalesce(keys, empty).alias("keys"))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "keys")
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            rows.schema["doc_id"],
            T.StructField("words", T.LongType()),
            T.StructField("crossing", T.BinaryType()),
            T.StructField("keys", T.ArrayType(T.BinaryType())),
        ]
    )
    # The numbers hold once they are written.
    return stage(rows.mapInArrow(run, schema), "resampling-documents")


def _bucket_counts(lines: DataFrame, docs: DataFrame, buckets: int) -> list[int]:
    """How often each bucket comes in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            sizes = np.array([len(b) // 2 for b in batch.column(1).to_pylist()], dtype=np.int64)
            flat = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16)
            times = np.repeat(batch.column(0).to_numpy(), sizes)
            # Exact: whole numbers below 2**53.
            total += np.bincount(flat, times, buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    parts = lines.select("n", "buckets").union(docs.select(F.lit(1).cast("bigint"), "crossing"))
    summed = parts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = [0] * buckets
    for row in summed.collect():  # at most one row a bucket
        counts[row.bucket] = row.n
    return counts


def _texts(table: DataFrame, id_col: str | None, text_col: str) -> DataFrame:
    of_id = F.col(id_col) if id_col else F.lit(None).cast("bigint")
    return table.select(of_id.alias("doc_id"), F.col(text_col).alias("text"))


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """Per bucket a thousand times the logarithm of how much likelier the target is to hold it, rounded down."""
    n, s, t = len(corpus), sum(corpus), sum(target)
    return [
        math.floor(1000 * math.log(float(b + 1) * float(s + n) / (float(a + 1) * float(t + n)))) for a, b in zip(corpus, target, strict=True)
    ]


def _gained(rows: DataFrame, gain: list[int], column: str, others: list[str]) -> DataFrame:
    """The other columns and weight: the sum of the gains of the buckets in a binary column."""
    table = np.array(gain, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int(table[np.frombuffer(b, dtype=np.uint16)].sum()) for b in batch.column(0).to_pylist()]
            yield pa.record_batch([*batch.columns[1:], pa.array(found, pa.int64())], names=[*others, "weight"])

    chosen = rows.select(column, *others)
    return chosen.mapInArrow(run, T.StructType([*chosen.schema.fields[1:], T.StructField("weight", T.LongType())]))


def weights(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS
) -> DataFrame:
    """Per row of docs: row (its number), doc_id, words, n_features, weight."""
    if buckets > 1 << 16:
        raise ValueError("buckets must fit 16 bits")
    texts = _texts(docs, id_col, text_col)
    lines, rows = _distinct_lines(texts, buckets), _documents(texts, buckets)
    aim = _texts(target, None, target_text)
    aim_counts = _bucket_counts(_distinct_lines(aim, buckets), _documents(aim, buckets), buckets)
    gain = gains(_bucket_counts(lines, rows, buckets), aim_counts)

    weighed = stage(_gained(lines, gain, "buckets", ["key", "n"]), "resampling-weights")
    total = weighed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * FREQUENT >= total
    held = rows.select("row", F.explode("keys").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("times"))
    frequent = F.broadcast(weighed.filter(often).select("key", "weight"))
    looked_up = held.join(frequent, "key")
    joined = held.join(frequent, "key", "left_anti").join(weighed.filter(~often).select("key", "weight"), "key")
    within = looked_up.unionByName(joined).select("row", (F.col("times") * F.col("weight")).alias("weight"))
    across = _gained(rows, gain, "crossing", ["row"])
    summed = within.unionByName(across).groupBy("row").agg(F.sum("weight").alias("weight"))
    n = F.col("words")
    features = n + F.greatest(n - 1, F.lit(0)) + F.greatest(n - 2, F.lit(0))
    return rows.select("row", "doc_id", "words", features.alias("n_features")).join(summed, "row")


def noise(id_col: str, seed: int = SEED) -> Column:
    """A thousand times a Gumbel variate that depends on the id alone, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """(row, rank) of the ``drawn`` highest scores, ties to smaller ids."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number says the range and the place in it; it holds once it is written.
    place = F.monotonically_increasing_id()
    placed = stage(sorted_rows.select("row", place.alias("place")), "resampling-order")
    part = F.shiftright("place", 33)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect())
    before, ranges = 0, []
    for number, size in sizes:  # one entry a range
        ranges.append((number, before))
        before += size
    parts = longs([number for number, _ in ranges])
    starts = longs([start for _, start in ranges])
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    rank = F.element_at(starts, F.array_position(parts, part).cast("int")) + within + 1
    return placed.select("row", rank.alias("rank")).filter(F.col("rank") <= drawn)


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    *,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Per row: doc_id, n_features, weight, score, rank: 1, 2, 3... for the drawn ``percent`` of the documents with
    at least ``least_words`` words, by score; null for the others."""
    weighed = weights(docs, target, id_col, text_col, target_text, buckets)
    scored = stage(weighed.withColumn("score", F.col("weight") + noise("doc_id", seed)), "resampling-scores")
    eligible = scored.filter(F.col("words") >= least_words)
    ranked = _ranked(eligible.select("row", "doc_id", "score"), percent * eligible.count() // 100)
    return scored.join(ranked, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
