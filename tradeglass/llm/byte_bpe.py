"""Byte-level BPE encoding and decoding by the ranks of a vocabulary file.

A text is cut by the pattern, and each match is merged by itself: the pair of neighbours with the lowest
rank first, the leftmost of equals.  A segment tree over the byte positions holds, for each live position,
the rank of the pair that starts there; its root is the leftmost minimum.  A merge changes three
positions, so a match of n bytes takes n log n steps, however long it is.  The trees of many short matches
are kept in one array, and are worked on together.

Most words of a corpus come again and again, so each Python worker keeps the ids of the words met last, in
a table of bounded size.

Cases: a null text counts as empty and has no ids.  Text that looks like a special token is ordinary
text.  Lone surrogates cannot occur in a Spark string.  Rows that repeat an id are encoded each.  Only id and
text are read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words whose ids a worker keeps; a fuller table starts afresh.
CACHED = 1 << 20
# Matches up to this many bytes are merged side by side, in blocks of so many.
_WIDEST = 64
_SIDE_BY_SIDE = 4096
_NO_PAIR = (1 << 31) - 1
_NONE = 1 << 62
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
_AT = (1 << 32) - 1


class _Pairs:
    """Which two tokens make a third: a hash table with open addressing, for lookups of whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        keys, values = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.at = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, -1, np.int64)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.at[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.at[slot[put]], self.rank[slot[put]] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], self._next(slot[rest])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) & ((1 << self.bits) - 1)

    def keys(self, left: np.ndarray, right: np.ndarray, position: np.ndarray) -> np.ndarray:
        """rank << 6 | position of each pair, or _NO_PAIR; an id below zero is in no pair."""
        wanted = left.astype(np.int64) << 32 | right.astype(np.int64)
        shape, wanted = wanted.shape, np.where((left < 0) | (right < 0), -2, wanted).reshape(-1)
        slot = self._slot(wanted)
        rank = np.where(self.at[slot] == wanted, self.rank[slot], -1)
        open_ = np.flatnonzero((self.at[slot] != wanted) & (self.at[slot] != -1) & (wanted >= 0))
        slot = slot[open_]
        while len(open_):
            slot = self._next(slot)
            hit = self.at[slot] == wanted[open_]
            rank[open_[hit]] = self.rank[slot[hit]]
            more = ~hit & (self.at[slot] != -1)
            open_, slot = open_[more], slot[more]
        rank = rank.reshape(shape)
        return np.where(rank < 0, _NO_PAIR, rank << 6 | position).astype(np.int32)


class ByteBPE:
    """Encoder and decoder of one vocabulary: lines of a base64 token and its rank."""

    def __init__(self, ranks_file: bytes, pattern: str):
        lines = (line.split() for line in ranks_file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self._pairs = _Pairs(self.ranks)
        self._bytes = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self._decimal = {str(rank): token for token, rank in self.ranks.items()}
        self._words: dict[str, str] = {}

    def encode(self, text: str) -> list[int]:
        joined = self.encode_all([text])[0]
        return [int(i) for i in joined.split(",")] if joined else []

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def encode_all(self, texts: list[str]) -> list[str]:
        """Per text its ids in decimal, joined by commas."""
        chunks = [self._chunks(text) for text in texts]
        self._learn(set().union(*chunks))
        made = [",".join(map(self._words.__getitem__, parts)) for parts in chunks]
        if len(self._words) > CACHED:
            self._words.clear()
        return made

    def decode_joined(self, joined: str) -> bytes:
        return b"".join(map(self._decimal.__getitem__, joined.split(","))) if joined else b""

    def _chunks(self, text: str) -> list[str]:
        """Parts of the text that the pattern cuts by themselves.  If white space is only single blanks and
        line ends between words, a match starts at each of them; else the text is cut into matches."""
        if "\0" not in text and " ".join(text.split()) == text.replace("\n", " ") and text:
            return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return self.pattern.findall(text)

    def _learn(self, chunks: set[str]) -> None:
        """Make sure that the ids of all these chunks are known."""
        cut = {chunk: self.pattern.findall(chunk) for chunk in chunks.difference(self._words)}
        pieces = list({piece for parts in cut.values() for piece in parts})
        ids = dict(zip(pieces, self.merge_all([piece.encode() for piece in pieces]), strict=True))
        for chunk, parts in cut.items():
            self._words[chunk] = ",".join([ids[piece] for piece in parts])

    def merge_all(self, pieces: list[bytes]) -> list[str]:
        """Per match its ids in decimal, joined by commas.  Short matches of about the same length are merged
        side by side."""
        made: list[str] = [""] * len(pieces)
        alike: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                made[at] = str(whole)
            elif len(piece) > _WIDEST:
                made[at] = ",".join(map(str, self.merge(piece)))
            else:
                alike.setdefault(1 << (len(piece) - 1).bit_length(), []).append(at)
        for size, places in alike.items():
            for first in range(0, len(places), _SIDE_BY_SIDE):
                block = places[first : first + _SIDE_BY_SIDE]
                for at, ids in zip(block, self._merge_block([pieces[i] for i in block], size), strict=True):
                    made[at] = ids
        return made

    def _merge_block(self, pieces: list[bytes], size: int) -> list[str]:
        """Matches of at most ``size`` bytes: one segment tree each, all trees in one array, and one merge per
        match and round.  A leaf holds rank << 6 | position, so the root is the leftmost of the lowest rank."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        inside = np.arange(size) < lengths[:, None]
        ids = np.full((n, size + 1), -1, np.int32)  # the last column stands for the end
        ids[:, :size][inside] = self._bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, size + 2), (n, 1))
        after[np.arange(n), lengths - 1] = size
        before = np.tile(np.arange(-1, size), (n, 1))
        before[:, size] = lengths - 1
        tree = np.full((n, 2 * size), _NO_PAIR, np.int32)
        tree[:, size : 2 * size - 1] = self._pairs.keys(ids[:, : size - 1], ids[:, 1:size], np.arange(size - 1))
        for at in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * at], tree[:, 2 * at + 1], out=tree[:, at])
        flat, row = tree.reshape(-1), np.arange(n)

        def put(base: np.ndarray, position: np.ndarray, key: np.ndarray | int) -> None:
            node = size + position
            flat[base + node] = key
            for _ in range(size.bit_length() - 1):
                node = node >> 1
                at = base + 2 * node
                flat[base + node] = np.minimum(flat[at], flat[at + 1])

        while True:
            row = row[tree[row, 1] != _NO_PAIR]
            if not len(row):
                break
            base, best = row * (2 * size), tree[row, 1]
            i, merged = best & 63, best >> 6
            j = after[row, i]
            end, left = after[row, j], before[row, i]
            ids[row, i], ids[row, j] = merged, -1
            after[row, i], before[row, end] = end, i
            put(base, j, _NO_PAIR)
            put(base, i, self._pairs.keys(merged, ids[row, end], i))
            some = left >= 0
            left, base = left[some], base[some]
            put(base, left, self._pairs.keys(ids[row[some], left], merged[some], left))
        live = ids[:, :size] >= 0
        decimal = list(map(str, ids[:, :size][live].tolist()))
        ends = np.cumsum(live.sum(axis=1)).tolist()
        return [",".join(decimal[a:b]) for a, b in zip([0, *ends], ends, strict=False)]

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one match of any length."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        # Leaves hold rank << 32 | position, so the smallest is the leftmost of the lowest rank.
        size = 1 << (n - 2).bit_length() if n > 2 else 1
        tree = [_NONE] * (2 * size)
        get = ranks.get
        for i in range(n - 1):
            rank = get(piece[i : i + 2])
            if rank is not None:
                tree[size + i] = rank << 32 | i
        for at in range(size - 1, 0, -1):
            a, b = tree[2 * at], tree[2 * at + 1]
            tree[at] = a if a < b else b
        # Position n ends the list of live positions.
        after = list(range(1, n + 2))
        before = list(range(-1, n + 1))

        def put(position: int, key: int) -> None:
            at = size + position
            tree[at] = key
            while at > 1:
                other = tree[at ^ 1]
                if other < key:
                    key = other
                at >>= 1
                if tree[at] == key:
                    return
                tree[at] = key

        while tree[1] != _NONE:
            i = tree[1] & _AT
            j = after[i]
            end = after[i] = after[j]
            before[end] = i
            if j < n - 1:
                put(j, _NONE)
            rank = get(piece[i : after[end]]) if end < n else None
            put(i, _NONE if rank is None else rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = get(piece[h:end])
                put(h, _NONE if rank is None else rank << 32 | h)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : after[i]]])
            i = after[i]
        return ids


_loaded: dict[tuple[bytes, str], ByteBPE] = {}


def _vocabulary(ranks_file: bytes, pattern: str) -> ByteBPE:
    """The encoder of a vocabulary, built once in each Python worker."""
    key = (hashlib.sha256(ranks_file).digest(), pattern)
    if key not in _loaded:
        _loaded[key] = ByteBPE(ranks_file, pattern)
    return _loaded[key]


def _run(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, make: Callable, schema: str) -> DataFrame:
    """Per row the id and what ``make`` returns for the encoder and a batch of texts.  The vocabulary file, about a
    megabyte, is read by the driver and broadcast."""
    with open(path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {schema}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _vocabulary(ranks.value, pattern)
        for batch in batches:
            made = make(bpe, batch.column(1).to_pylist())
            fields = [part.split() for part in schema.split(", ")][1:]
            columns = [pa.array([row[i] for row in made], _ARROW[kind]) for i, (_, kind) in enumerate(fields)]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", *(name for name, _ in fields)])

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<bigint>)."""

    def make(bpe: ByteBPE, texts: list[str | None]) -> list[tuple]:
        return [([int(i) for i in x.split(",")] if x else [],) for x in bpe.encode_all([t or "" for t in texts])]

    return _run(docs, path, pattern, id_col, text_col, make, "ids array<bigint>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, decoded binary) of rows with ids."""

    def make(bpe: ByteBPE, rows: list[list[int] | None]) -> list[tuple]:
        return [(bpe.decode(ids or []),) for ids in rows]

    return _run(encoded, path, pattern, id_col, "ids", make, "decoded binary")


def encoded_digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 and, of the ids decoded again, decoded_sha256."""

    def make(bpe: ByteBPE, texts: list[str | None]) -> list[tuple]:
        return [
            (
                joined.count(",") + 1 if joined else 0,
                hashlib.sha256(joined.encode()).hexdigest(),
                hashlib.sha256(bpe.decode_joined(joined)).hexdigest(),
            )
            for joined in bpe.encode_all([t or "" for t in texts])
        ]

    return _run(docs, path, pattern, id_col, text_col, make, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
