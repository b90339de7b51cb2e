"""Removal of repeated passages: word sequences that an earlier document has, too.

A window is a run of 50 words.  A word goes if it lies in a window whose words also start somewhere in a
document with a smaller id.  That is a question about the suffix tree of all documents: windows are equal just
if their suffixes pass through the same node at a depth of 50 words.

The suffixes are split into groups that share part of their prefix.  Of the 16-word grams within its first 50
words, a suffix goes by the one with the smallest hash.  Equal windows choose the same gram, and so do
neighbouring suffixes for about 17 words, so such a run travels as one stretch of words, not as a
prefix for each.  Grams that only one document chooses cannot hold a repeat and are dropped first.

A group of up to ``GROUP`` documents is small enough for a task: its subtree is built as a sorted list of
suffixes with the depths at which neighbours part, and nodes of depth 50 give the repeats.  For a gram that
more documents choose, the prefix is lengthened to all 50 words: then a group is a single node, of which only
the smallest id is wanted, and partial aggregation finds that without gathering the group.

Words are compared by hashes: 32 bits a word beside the 64 bits of the gram in subtrees, 128 bits a window
in long groups.

Cases: a null text has no words.  Rows with a null id are left whole and remove nothing elsewhere.
Rows that repeat an id do not remove each other's words.  Texts of fewer than 50 words stay whole.  Only id
and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 50
GRAM = 16
# Documents that one subtree is built of at most.
GROUP = 1_000
# Parts that the rows of one window are spread over.
SALTS = 16
# Suffixes that are sorted at a time; a block holds whole groups.
_BLOCK = 60_000
# Arrays of one number: their products wrap around.
_ODD, _OTHER = (np.array([f], dtype=np.uint64) for f in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95))


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], dtype=np.uint64)


def _rolled(hashes: np.ndarray, length: int, factor: np.ndarray) -> np.ndarray:
    """A hash of each run of ``length`` words, made of hashes of shorter runs."""
    power = {1: factor}
    runs, size = {1: hashes}, 1
    while size * 2 <= length:
        half = runs[size]
        runs[size * 2] = half[: len(half) - size] + half[size:] * power[size]
        power[size * 2] = power[size] * power[size]
        size *= 2
    made, at, scale = np.zeros(max(len(hashes) - length + 1, 0), np.uint64), 0, np.ones(1, np.uint64)
    while at < length:
        while size > length - at:
            size //= 2
        made = made + runs[size][at : at + len(made)] * scale
        scale, at = scale * power[size], at + size
    made = (made ^ (made >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return made ^ (made >> np.uint64(32))


class Suffixes:
    """The suffixes of one text that have at least a window of words, in runs that go by the same gram."""

    def __init__(self, words: list[bytes], window: int = WINDOW, gram: int = GRAM):
        self.words, self.window = words, window
        self.first = self.last = np.zeros(0, np.int64)
        self.gram = np.zeros(0, np.int64)
        if len(words) < window:
            return
        self.hashes = word_hashes(words)
        grams = _rolled(self.hashes, gram, _ODD)
        # In slices, as a long text would need a large array.
        places = [
            sliding_window_view(grams[at : at + 65_536 + window - gram], window - gram + 1).argmin(axis=1) + at_offset
            for at in range(0, len(grams) - window + gram, 65_536)
            for at_offset in [np.arange(at, min(at + 65_536, len(grams) - window + gram))]
        ]
        chosen = np.concatenate(places)
        starts = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        self.first = starts
        self.last = np.append(starts[1:], len(chosen)) - 1
        self.gram = grams[chosen[starts]].view(np.int64)

    def stretch(self, run: int) -> bytes:
        """32-bit hashes of the words of a run's suffixes, in an order that sorts by bytes, without zero bytes
        at the end."""
        words = self.hashes[self.first[run] : self.last[run] + self.window]
        return ((words >> np.uint64(32)).astype(np.uint32) | np.uint32(1)).astype(">u4").tobytes()

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of hash for the whole window that each suffix starts with."""
        pair = (_rolled(self.hashes, self.window, f) for f in (_ODD, _OTHER))
        return tuple(x.view(np.int64) for x in pair)  # type: ignore[return-value]


def repeats(block: list[tuple[int, int, int, int, bytes]], window: int = WINDOW) -> list[tuple[int, int, int, int]]:
    """From stretches (gram, id, text key, first suffix, words) of whole groups: the word ranges (id, text key,
    start, end) that repeat a smaller id."""
    sizes = np.array([len(words) // 4 - window + 1 for *_, words in block])
    owner = np.repeat(np.arange(len(block)), sizes)
    ids = np.array([b[1] for b in block])[owner]
    width = 8 + 4 * window
    suffixes = np.empty((len(owner), width), np.uint8)
    at = 0
    for (gram, _, _, _, words), size in zip(block, sizes.tolist(), strict=True):
        suffixes[at : at + size, :8] = np.frombuffer(gram.to_bytes(8, "big", signed=True), np.uint8)
        suffixes[at : at + size, 8:] = sliding_window_view(np.frombuffer(words, np.uint8), 4 * window)[::4]
        at += size
    # The suffix list in order, and how deep neighbours go together: the subtree.
    order = np.argsort(suffixes.view(f"S{width}").reshape(-1), kind="stable")
    in_order = suffixes[order]
    apart = in_order[1:] != in_order[:-1]
    depth = np.where(apart.any(axis=1), np.maximum(apart.argmax(axis=1) - 8, 0) // 4, window)
    node = np.concatenate(([0], np.flatnonzero(depth < window) + 1))
    smallest = np.minimum.reduceat(ids[order], node)
    later = np.zeros(len(owner), bool)
    later[order] = ids[order] > np.repeat(smallest, np.diff(np.append(node, len(order))))
    ranges = []
    ends = np.cumsum(sizes)
    for at in np.unique(owner[later]).tolist():
        _, doc, key, first, _ = block[at]
        own = np.flatnonzero(later[ends[at] - sizes[at] : ends[at]])
        for run in np.split(own, np.flatnonzero(np.diff(own) > 1) + 1):
            ranges.append((doc, key, first + int(run[0]), first + int(run[-1]) + window))
    return ranges


def _without(words: list[bytes], ranges: list[dict]) -> list[bytes]:
    kept, at = [], 0
    for a, b in sorted((r["a"], r["b"]) for r in ranges):
        if a > at:
            kept += words[at:a]
        at = max(at, b)
    return kept + words[at:]


def _choices(texts: DataFrame) -> DataFrame:
    """(doc_id, key, gram): the grams that suffixes of a text go by, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.unique(Suffixes((t or b"").split()).gram) for t in batch.column(2).to_pylist()]
            rows = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
            owner = pa.array(rows, pa.int64())
            made = pa.array(np.concatenate([*grams, np.zeros(0, np.int64)]), pa.int64())
            yield pa.record_batch([batch.column(0).take(owner), batch.column(1).take(owner), made], names=["doc_id", "key", "gram"])

    return texts.mapInArrow(run, "doc_id bigint, key bigint, gram bigint")


def _stretches(picked: DataFrame) -> DataFrame:
    """From texts with the grams to look at: (gram, doc_id, key, first, words), a row per run of suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, picks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = Suffixes(text.split())
                runs = np.flatnonzero(np.isin(own.gram, np.array(picks, np.int64))).tolist()
                yield pa.record_batch(
                    [
                        pa.array(own.gram[runs], pa.int64()),
                        pa.array([doc] * len(runs), pa.int64()),
                        pa.array([key] * len(runs), pa.int64()),
                        pa.array(own.first[runs], pa.int64()),
                        pa.array([own.stretch(r) for r in runs], pa.binary()),
                    ],
                    names=["gram", "doc_id", "key", "first", "words"],
                )

    return picked.mapInArrow(run, "gram bigint, doc_id bigint, key bigint, first bigint, words binary")


def _paths(picked: DataFrame) -> DataFrame:
    """From texts with the grams to look at: (high, low, doc_id, key, first), a row per suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, key, text, picks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = Suffixes(text.split())
                runs = np.flatnonzero(np.isin(own.gram, np.array(picks, np.int64)))
                if not len(runs):
                    continue
                high, low = own.paths()
                at = np.concatenate([np.arange(own.first[r], own.last[r] + 1) for r in runs])
                same = [pa.array(np.full(len(at), x), pa.int64()) for x in (doc, key)]
                yield pa.record_batch(
                    [pa.array(high[at]), pa.array(low[at]), *same, pa.array(at, pa.int64())],
                    names=["high", "low", "doc_id", "key", "first"],
                )

    return picked.mapInArrow(run, "high bigint, low bigint, doc_id bigint, key bigint, first bigint")


def _in_subtrees(stretches: DataFrame) -> DataFrame:
    """(doc_id, key, a, b): repeated word ranges, by subtrees of whole groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> pa.RecordBatch:
            ranges = repeats(block) if block else []
            columns = [pa.array([r[i] for r in ranges], pa.int64()) for i in range(4)]
            return pa.record_batch(columns, names=["doc_id", "key", "a", "b"])

        block: list[tuple[int, int, int, int, bytes]] = []
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held >= _BLOCK and row[0] != block[-1][0]:
                    yield found()
                    block, held = [], 0
                block.append(row)
                held += len(row[4]) // 4 - WINDOW + 1
        yield found()

    parts = int(stretches.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = stretches.repartition(parts, "gram").sortWithinPartitions("gram")
    return grouped.mapInArrow(run, "doc_id bigint, key bigint, a bigint, b bigint")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 and, if wanted, the kept words joined by blanks.

    One plan: the texts are shuffled by id once, and that exchange serves all joins."""
    # A column that needs no new name gets none: Spark takes an exchange again only if its plan is the same.
    named = docs if id_col == "doc_id" else docs.select(F.col(id_col).alias("doc_id"), F.col(text_col))
    own = F.col("doc_id") if dict(named.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    rows = named.select(own, F.col(text_col).cast("binary").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("key"), "text")
    texts = rows.filter("doc_id is not null and text is not null")
    choices = _choices(texts)
    shared = (
        choices.groupBy("gram")
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter("low < high")
        .select(F.col("gram").alias("shared"), "n")
    )
    picks = choices.join(shared, F.col("gram") == F.col("shared")).groupBy("doc_id", "key")
    picks = picks.agg(
        F.collect_list(F.when(F.col("n") <= GROUP, F.col("gram"))).alias("few"),
        F.collect_list(F.when(F.col("n") > GROUP, F.col("gram"))).alias("many"),
    ).withColumnsRenamed({"doc_id": "of_id", "key": "of_key"})
    same = (F.col("doc_id") == F.col("of_id")) & (F.col("key") == F.col("of_key"))
    picked = texts.join(picks, same)
    light = _in_subtrees(_stretches(picked.filter(F.size("few") > 0).select("doc_id", "key", "text", "few")))
    paths = _paths(picked.filter(F.size("many") > 0).select("doc_id", "key", "text", "many"))
    # A passage may be in a third of all documents: its rows are spread by a hash of the id.
    smallest = (
        paths.groupBy("high", "low")
        .agg(F.min("doc_id").alias("smallest"), F.max("doc_id").alias("largest"))
        .filter("smallest < largest")
        .select("high", "low", "smallest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = paths.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    heavy = (
        salted.join(smallest, ["high", "low", "salt"])
        .filter("doc_id > smallest")
        .select("doc_id", "key", F.col("first").alias("a"), (F.col("first") + WINDOW).alias("b"))
    )
    ranges = (
        light.union(heavy)
        .groupBy(F.col("doc_id").alias("of_id"), F.col("key").alias("of_key"))
        .agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    )
    marked = texts.join(ranges, same, "left").select("doc_id", "text", "ranges")
    apart = rows.filter("doc_id is null or text is null").select("doc_id", "text", F.lit(None).cast(marked.schema["ranges"].dataType).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = (text or b"").split()
                kept = _without(words, found) if found else words
                made.append((len(words), len(words) - len(kept), b" ".join(kept)))
            columns = [
                batch.column(0),
                pa.array([m[0] for m in made], pa.int64()),
                pa.array([m[1] for m in made], pa.int64()),
                pa.array([hashlib.sha256(m[2]).hexdigest() for m in made], pa.string()),
            ]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns.append(pa.array([m[2].decode() for m in made], pa.string()))
                names.append("text")
            yield pa.record_batch(columns, names=names)

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    return marked.union(apart).mapInArrow(run, schema + ", text string" * with_text)
