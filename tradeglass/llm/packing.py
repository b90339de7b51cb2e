"""Packing of documents into sequences of one length, with lexical neighbours side by side.

Documents are tokenised and sorted by the term that marks them most, so that a range partition, and each
block of it, holds documents about the same things.  A block is one shard of a BM25 inverted index; its term
statistics are those of the whole corpus.  Within a block the next unused document seeds a window; the
index returns its best unused neighbours, which fill the window greedily.  The last of them is cut where the
window ends, and its rest seeds the next window.  Only the end of a partition is left over: it is cut into
sequences whose lengths are powers of two, which need no padding.  So no sequence is padded at all.

A block has a bounded number of documents and ids; a window has at most its length in ids.  A hot term is
split by a hash of the id like any other range.

Cases: a null text counts as empty; an empty document is its end id alone.  A document of any length is cut
into as many pieces as it needs.  Rows that repeat an id are packed each.  Only id and text are read; an empty
table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeglass.llm import word_bpe
from tradeglass.llm.common import stage, unstage

WINDOW = 2048
END_ID = 1
# Ids per partition at most, and documents and ids per index shard.
PARTITION_IDS = 64_000_000
BLOCK_DOCS, BLOCK_IDS = 2_000, 2_000_000
# Terms of the seed that the index is asked for: those that weigh most.
QUERY_TERMS = 24
_K1, _B = 1.2, 0.75
_VOCABULARY = 1 << 16

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
)


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids binary): 16-bit little-endian ids, with the end id.  The tokenizer file, of a few
    megabytes, is read by the driver and broadcast."""
    with open(path, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    end = end_id.to_bytes(2, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe.loaded(definition.value)
        for batch in batches:
            ids = pa.array([bpe.encode(text or "") + end for text in batch.column(1).to_pylist()], pa.binary())
            yield pa.record_batch([batch.column(0), ids], names=["doc_id", "ids"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u2")


def _distinct(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (token, document) pairs in order, and how often each occurs."""
    if not docs:
        return (np.zeros(0, np.int64),) * 3
    token, owner = np.concatenate(docs), np.repeat(np.arange(len(docs)), [len(ids) for ids in docs])
    # Stable sorting of 16-bit numbers goes by digits, and keeps the documents in order.
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (owner[1:] != owner[:-1]))))
    return token[first].astype(np.int64), owner[first], np.diff(np.append(first, len(token)))


def _terms_by_document(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as ``_distinct``, by document and then token: sorted as one number."""
    if not docs:
        return (np.zeros(0, np.int64),) * 3
    pair = np.repeat(np.arange(len(docs), dtype=np.uint64) << np.uint64(16), [len(ids) for ids in docs]) | np.concatenate(docs)
    pair.sort()
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    own = pair[first].astype(np.int64)
    return own & 0xFFFF, own >> 16, np.diff(np.append(first, len(pair)))


def _heaviest(docs: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Per document the term that weighs most, the smaller id of equals."""
    token, owner, n = _terms_by_document(docs)
    weight = _weight(token, n, idf)
    starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    best = np.flatnonzero(weight == np.repeat(np.maximum.reduceat(weight, starts), np.diff(np.append(starts, len(owner)))))
    return token[best[np.unique(owner[best], return_index=True)[1]]]


def _weight(token: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return idf[token] * n / (n + _K1)


def document_counts(tokens: DataFrame) -> np.ndarray:
    """Per token, how many documents of the corpus have it; at most 65,536 counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_VOCABULARY, np.int64)
        for batch in batches:
            token, _, _ = _terms_by_document([_ids(data) for data in batch.column(0).to_pylist()])
            counts += np.bincount(token, minlength=_VOCABULARY)
        token = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(token), pa.array(counts[token])], names=["token", "n"])

    counts = np.zeros(_VOCABULARY, np.int64)
    total = tokens.select("ids").mapInArrow(run, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    for token, n in total.collect():
        counts[token] = n
    return counts


def inverse_frequency(counts: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p((documents - counts + 0.5) / (counts + 0.5)).astype(np.float32)


def _terms(ids: np.ndarray, idf: np.ndarray, most: int) -> np.ndarray:
    """The distinct ids that weigh most in a document, by frequency and rarity, ties by the smaller id."""
    token, n = np.unique(ids, return_counts=True)
    weight = _weight(token, n, idf)
    return token[np.argsort(-weight, kind="stable")[:most]]


class Index:
    """BM25 inverted index of one block: per term its documents and their weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        sizes = np.array([len(ids) for ids in docs], dtype=np.int64)
        term, self.doc, n = _distinct(docs)
        length = _K1 * (1 - _B + _B * sizes[self.doc] / mean)
        self.weight = (idf[term] * n * (_K1 + 1) / (n + length)).astype(np.float32)
        self.start = np.searchsorted(term, np.arange(_VOCABULARY + 1))
        self.size = len(docs)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        found = np.zeros(self.size, np.float32)
        for a, b in zip(self.start[terms].tolist(), self.start[terms + 1].tolist(), strict=True):
            found[self.doc[a:b]] += self.weight[a:b]
        return found


class Packer:
    """Fills windows from one partition, block by block."""

    def __init__(self, idf: np.ndarray, mean: float, window: int, sequence: int):
        self.idf, self.mean, self.window, self.sequence = idf, mean, window, sequence
        self.rest: list[tuple[object, np.ndarray, int, int]] = []
        self.rows: list[tuple] = []

    def pack(self, block: list[tuple[object, np.ndarray, int, int]]) -> None:
        """Documents as (id, remaining ids, ids before them, all ids).  What does not fill a window waits
        for the next block."""
        block = self.rest + block
        index = Index([ids for _, ids, _, _ in block], self.idf, self.mean)
        free = np.ones(len(block), bool)
        at, self.rest = 0, []
        seed: int | None = None
        while True:
            if seed is None:
                while at < len(block) and not free[at]:
                    at += 1
                if at == len(block):
                    break
                seed, free[at] = at, False
            doc, ids, before, total = block[seed]
            while len(ids) >= self.window:
                self._put([(doc, ids[: self.window], before, total)])
                ids, before = ids[self.window :], before + self.window
            if not len(ids):
                seed = None
                continue
            pieces, room = [(doc, ids, before, total)], self.window - len(ids)
            cut = None
            for near in self._neighbours(index, ids, free):
                doc, ids, before, total = block[near]
                free[near] = False
                pieces.append((doc, ids[:room], before, total))
                if len(ids) > room:
                    block[near] = (doc, ids[room:], before + room, total)
                    cut = near
                room -= min(room, len(ids))
                if not room:
                    break
            if room:
                self.rest = pieces
                break
            self._put(pieces)
            seed = cut

    def _neighbours(self, index: Index, ids: np.ndarray, free: np.ndarray) -> Iterator[int]:
        """Unused documents, the best first; those that share no term come last, in their order."""
        scores = index.scores(_terms(ids, self.idf, QUERY_TERMS))
        left = np.flatnonzero(free)
        scores = scores[left]
        if len(left) > 8:
            # The best eight mostly fill a window.
            best = np.argpartition(-scores, 8)[:8]
            best = best[np.argsort(-scores[best], kind="stable")]
            yield from left[best].tolist()
            scores[best] = np.inf
            yield from left[np.argsort(-scores, kind="stable")[8:]].tolist()
        else:
            yield from left[np.argsort(-scores, kind="stable")].tolist()

    def end(self) -> None:
        """Cut what is left into sequences of lengths that are powers of two."""
        pieces, self.rest = self.rest, []
        left = sum(len(ids) for _, ids, _, _ in pieces)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            sequence = []
            while room:
                doc, ids, before, total = pieces.pop(0)
                sequence.append((doc, ids[:room], before, total))
                if len(ids) > room:
                    pieces.insert(0, (doc, ids[room:], before + room, total))
                room -= min(room, len(ids))
            self._put(sequence)

    def _put(self, pieces: list[tuple[object, np.ndarray, int, int]]) -> None:
        offset = 0
        for doc, ids, before, total in pieces:
            wide = ids.astype("<u4").tobytes()
            self.rows.append((doc, before, len(ids), zlib.crc32(wide), total, self.sequence, offset, ids.tobytes()))
            offset += len(ids)
        self.sequence += 1

    def taken(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame, path: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Per piece: doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens, sequence_id,
    offset in the sequence; with its 16-bit ids, if wanted."""
    tokens = stage(tokenised(docs, path, id_col, text_col), "packing-tokens")
    size = (F.length("ids") / 2).cast("long")
    documents, total = tokens.agg(F.count(F.lit(1)), F.sum(size)).first()
    idf = inverse_frequency(document_counts(tokens), documents)
    mean = (total or 0) / max(documents, 1) or 1.0
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    own = tokens.schema["doc_id"].dataType.simpleString()
    schema = PIECES.format(id=own) if with_ids else PIECES.format(id=own).removesuffix(", ids binary")

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_ = [_ids(data) for data in batch.column(1).to_pylist()]
            terms = _heaviest(docs_, shared.value) if docs_ else np.zeros(0, np.int64)
            yield pa.record_batch([*batch.columns, pa.array(terms, pa.int64())], names=["doc_id", "ids", "term"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        packer = Packer(shared.value, mean, window, (context.partitionId() if context else 0) << 40)
        kinds = [batches_type, *[pa.int64()] * 6, *[pa.binary()] * with_ids]
        names = [part.split()[0] for part in schema.split(", ")]

        def out() -> Iterator[pa.RecordBatch]:
            rows = packer.taken()
            for first in range(0, len(rows), 10_000):
                part = rows[first : first + 10_000]
                yield pa.record_batch([pa.array([r[i] for r in part], kind) for i, kind in enumerate(kinds)], names=names)

        block, held = [], 0
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                block.append((doc, _ids(data), 0, len(data) // 2))
                held += len(data) // 2
                if len(block) >= BLOCK_DOCS or held >= BLOCK_IDS:
                    packer.pack(block)
                    block, held = [], 0
                    yield from out()
        packer.pack(block)
        packer.end()
        yield from out()

    batches_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[own]
    set_ = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(set_, -(-(total or 0) // PARTITION_IDS))
    order = ["term", F.xxhash64("doc_id"), "doc_id"]
    # Ranges are placed by a pass over the rows, so terms are written and not made twice.
    ordered = stage(tokens.mapInArrow(marked, f"doc_id {own}, ids binary, term bigint"), "packing-terms")
    unstage(tokens)
    sorted_ = ordered.repartitionByRange(partitions, *order).sortWithinPartitions(*order, "ids")
    # Written once, as sequence ids hold for one run.
    return stage(sorted_.select("doc_id", "ids").mapInArrow(packed, schema), "packing-pieces")
