"""Near-duplicate documents by SimHash fingerprints and pigeonhole blocks.

A text is lower-cased (A-Z only) and cut into words at ASCII white space; each run of three words, repeats
included, is a shingle (the whole sequence if there are fewer words).  A bit of the fingerprint is set if
it is set in over half of the shingles' XXH64 hashes.  Fingerprints are linked if they differ in at most
two bits; documents with linked fingerprints form a component.

Copies share a fingerprint and are one row from there on, so a group of copies of any size costs one
row per map task.  Pairs and components are made of distinct fingerprints only.

Cases: a null, empty or blank text has the fingerprint zero, and is linked like any other.  Rows that
repeat an id get the same answer each time.  A null id is a component's id only if none of its rows has
another.  Only id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeglass.llm.common import stage
from tradeglass.llm.graph import components
from tradeglass.llm.hamming import close_pairs

SHINGLE = 3
SEED = 42
BITS = 2
BLOCKS = 5
# Shingles that are hashed at a time: bounds the memory that a very long text takes.
_CHUNK = 255 * 400
# Per byte value, its bits spread over the eight bytes of a long, so that bits are counted eight at a time.
_SPREAD = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], dtype="<u8")


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    spread = _SPREAD[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)]
    # 255 rows at most are added before a counter of one byte is read out.
    sums = np.add.reduceat(spread, np.arange(0, len(spread), 255), axis=0)
    return sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text, as an unsigned number."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK], strict=True)
        counts += _bit_counts(np.array([digest(joined[s:e], SEED) for s, e in spans], dtype=np.uint64))
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(starts)).tolist())


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The other columns, and fp: the fingerprint as a signed long."""
    others = [c for c in docs.columns if c != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t) for t in batch.column(len(others)).to_pylist()], dtype=np.uint64)
            columns = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.record_batch(columns, names=[*others, "fp"])

    rows = docs.select(*others, F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("fp", T.LongType())]))


def _first_of_components(prints: DataFrame, order: Column, blocks: int) -> DataFrame:
    """(fp, first): per fingerprint the smallest value of ``order`` in its component."""
    groups = stage(prints.groupBy("fp").agg(F.min(order).alias("own")), "simhash-groups")
    linked = components(close_pairs(groups.select("fp"), BITS, blocks, "simhash"), "simhash-links")
    members = stage(linked.join(groups, F.col("node") == F.col("fp")).select("fp", "root", "own"), "simhash-members")
    roots = members.groupBy("root").agg(F.min("own").alias("first"))
    named = members.join(roots, "root").select("fp", "first")
    return stage(groups.join(named, "fp", "left").select("fp", F.coalesce("first", "own").alias("first")), "simhash-classes")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (the smallest id of the component)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = stage(fingerprints(rows), "simhash")
    classes = _first_of_components(prints, F.col("doc_id"), blocks)
    # A fingerprint may have a third of the rows: both sides are shuffled, so Spark splits such a partition.
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first").alias("component_id")
    )


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """The documents that stay, one of each component, with all their columns: that with the smallest id; one
    without an id only if no other has one.  Rows that repeat id and text are one document."""
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    prints = stage(fingerprints(docs.select(F.col(id_col).alias("doc_id"), row.alias("row"), F.col(text_col).alias("text"))), "simhash")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    keep = _first_of_components(prints, order, blocks).select(F.col("first.row").alias("_keep")).distinct()
    once = Window.partitionBy("_row").orderBy(F.lit(0))
    return (
        docs.withColumn("_row", row)
        .join(keep, F.col("_row") == F.col("_keep"), "left_semi")
        .withColumn("_nth", F.row_number().over(once))
        .filter("_nth = 1")
        .drop("_nth", "_row")
    )
