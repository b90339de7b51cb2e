"""Periodic runs of words, found by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) that is at least
``exponent`` periods and ``least`` words long, and that no neighbouring word extends keeping period q.

The texts of a batch are one sequence of numbers, parted by numbers that come once.  Block compression (a
stretch of equal symbols becomes one symbol) and pair compression (symbols fall into a left and a right half at
random; a left one followed by a right one becomes one symbol) take turns until one symbol is left: a
run-length grammar.  Whether two neighbours end up in one phrase depends on those two alone, so equal stretches are
parsed alike, and how far the words from two places on agree is found by climbing and descending
the levels, a bounded number of comparisons on each.

Candidates come from a harmonic grid: a run of period q holds a multiple i of (exponent - 1) * q such that the words at i
and i + q agree; the sum over all q is n * log(n).  Extending a candidate to both sides by the grammar gives the
whole run exactly.  Of several periods of one stretch the smallest counts.

Cases: a null or empty text has no words and no runs.  Rows that repeat an id are worked on each.  Memory is in
proportion to the longest text, some 200 bytes a word.  Only id and text are read; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPONENT = 4
LEAST = 6
# Words whose grammar is built at a time, unless one text has more; candidates that are extended at a time.
_GROUP = 200_000
_CHUNK = 1 << 18
_RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
_RUN_TYPE = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

Words = list[bytes]


@dataclass
class _Level:
    """Symbols of a level, the phrase of the next level that each is in, and where the phrases begin."""

    symbols: np.ndarray
    parents: np.ndarray
    first: np.ndarray
    blocks: bool


def _halves(symbols: np.ndarray, turn: int) -> np.ndarray:
    """Whether each symbol falls into the left half, at random for every turn."""
    mixed = (symbols.astype(np.uint64) + np.uint64(turn << 32)) * np.uint64(0x9E3779B97F4A7C15)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed >> np.uint64(63) == 1


class Grammar:
    """Run-length grammar of a sequence that begins and ends with a number that comes once in it."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[_Level] = []
        self._names = int(symbols.max(initial=0)) + 1
        symbols, turn = symbols.astype(np.int32), 0
        while len(symbols) > 1:
            same = symbols[1:] == symbols[:-1]
            if same.any():
                symbols = self._add(symbols, ~same, True)
            turn += 1
            left = _halves(symbols, turn)
            joined = left[:-1] & ~left[1:]
            if joined.any():
                symbols = self._add(symbols, ~joined, False)

    def _add(self, symbols: np.ndarray, cuts: np.ndarray, blocks: bool) -> np.ndarray:
        """Phrases end at the cuts; returns the symbols of the next level.  Phrases of one symbol keep it."""
        first = np.concatenate(([0], np.flatnonzero(cuts) + 1, [len(symbols)])).astype(np.int32)
        sizes = np.diff(first)
        made = symbols[first[:-1]]
        long = np.flatnonzero(sizes > 1)
        tails = sizes[long] if blocks else symbols[first[long] + 1]
        _, names = np.unique(made[long].astype(np.int64) << 32 | tails, return_inverse=True)
        made[long] = self._names + names
        self._names += int(names.max(initial=-1)) + 1
        self.levels.append(_Level(symbols, np.repeat(np.arange(len(made), dtype=np.int32), sizes), first, blocks))
        return made

    def agreeing(self, x: np.ndarray, y: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from x and y on agree, to the right or to the left; x and y differ."""
        step = 1 if forward else -1
        begin, which = x, np.arange(len(x))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for level in self.levels:
            same = level.symbols[x] == level.symbols[y]
            differ = [(which[~same], x[~same], y[~same])]
            which, x, y = which[same], x[same], y[same]
            px, py = level.parents[x], level.parents[y]
            if forward:
                inside = (level.first[px] != x) | (level.first[py] != y)
                rest_x, rest_y = level.first[px + 1] - x, level.first[py + 1] - y
            else:
                inside = (level.first[px + 1] - 1 != x) | (level.first[py + 1] - 1 != y)
                rest_x, rest_y = x - level.first[px] + 1, y - level.first[py] + 1
            # Within a phrase: behind what both have left of it the next phrases begin, or the symbols differ.
            parted = inside & (rest_x != rest_y)
            if parted.any():
                least = np.minimum(rest_x, rest_y)[parted] * step
                differ.append((which[parted], x[parted] + least, y[parted] + least))
            found.append(tuple(np.concatenate(part) for part in zip(*differ, strict=True)))
            px, py = px + step * inside, py + step * inside
            which, x, y = which[~parted], px[~parted], py[~parted]
            if not len(which):
                break
        ends = np.empty_like(begin)
        which = x = y = np.empty(0, begin.dtype)
        for depth in range(len(found) - 1, -1, -1):
            if depth < len(found) - 1 and len(which):
                level = self.levels[depth]
                at = 0 if forward else 1
                cx, cy = level.first[x + at] - at, level.first[y + at] - at
                move = level.symbols[cx] == level.symbols[cy]
                if level.blocks:
                    move = move * np.minimum(level.first[x + 1] - level.first[x], level.first[y + 1] - level.first[y])
                x, y = cx + step * move, cy + step * move
            which, x, y = (np.concatenate(part) for part in zip((which, x, y), found[depth], strict=True))
        ends[which] = x
        return (ends - begin) * step


def _candidates(symbols: np.ndarray, longest: int, exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and periods q of the grid where the words at i and i + q agree."""
    places, periods, held = [], [], 0
    for q in range(1, longest // exponent + 1):
        step = (exponent - 1) * q
        hits = np.flatnonzero(symbols[:-q:step] == symbols[q::step]) * step
        if len(hits):
            places.append(hits)
            periods.append(np.full(len(hits), q))
            held += len(hits)
        if held >= _CHUNK:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find(texts: list[Words], exponent: int = EXPONENT, least: int = LEAST) -> list[np.ndarray]:
    """Per text its runs, as rows (start, length, period) by start, then period."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    parts = [list(map(number.__getitem__, words)) for words in texts]
    offsets = np.cumsum([1, *(len(words) + 1 for words in texts)])
    symbols = np.empty(offsets[-1], np.int32)
    # The numbers that part the texts come once each.
    symbols[0], symbols[offsets[1:] - 1] = len(number), len(number) + 1 + np.arange(len(texts))
    for part, offset in zip(parts, offsets, strict=False):
        symbols[offset : offset + len(part)] = part
    grammar = Grammar(symbols)
    kept = np.empty((0, 3), np.int64)
    for at, q in _candidates(symbols, max(map(len, texts), default=0), exponent):
        for a in range(0, len(at), _CHUNK):
            i, p = at[a : a + _CHUNK], q[a : a + _CHUNK]
            right, left = grammar.agreeing(i, i + p, True), grammar.agreeing(i - 1, i + p - 1, False)
            rows = np.stack((i - left, p + left + right, p), axis=1)
            kept = np.concatenate((kept, rows[rows[:, 1] >= np.maximum(least, exponent * p)]))
        # One row a stretch: that of the smallest period.
        kept = kept[np.lexsort((kept[:, 2], kept[:, 1], kept[:, 0]))]
        repeated = (kept[1:, 0] == kept[:-1, 0]) & (kept[1:, 1] == kept[:-1, 1])
        kept = kept[np.concatenate(([True], ~repeated))[: len(kept)]]
    kept = kept[np.lexsort((kept[:, 2], kept[:, 0]))]
    cuts = np.searchsorted(kept[:, 0], offsets)
    return [kept[a:b] - (offset, 0, 0) for a, b, offset in zip(cuts, cuts[1:], offsets, strict=False)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length over period, exactly; ties: smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best


def collapse(words: Words, runs: np.ndarray) -> Words:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


def _groups(texts: list[Words]) -> Iterator[list[Words]]:
    group, held = [], 0
    for words in texts:
        if group and held + len(words) > _GROUP:
            yield group
            group, held = [], 0
        group.append(words)
        held += len(words)
    if group:
        yield group


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    exponent: int = EXPONENT,
    least: int = LEAST,
    rewrite: Callable[[int | None, Words], Words] | None = None,
) -> DataFrame:
    """Per row: doc_id, runs (array of start, length and period, in words, by start, then period), best (the run
    with the greatest length over period, or null), collapsed (the words without those that a run holds after its
    first period, joined by blanks).  ``rewrite`` may change the words of a text before the search."""
    if exponent < 2:
        raise ValueError("a run repeats at least twice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [(text or b"").split() for text in batch.column(1).to_pylist()]
            if rewrite is not None:
                texts = [rewrite(i, words) for i, words in zip(ids, texts, strict=True)]
            runs = [found for group in _groups(texts) for found in find(group, exponent, least)]
            names = _RUN.fieldNames()
            listed = [[dict(zip(names, row, strict=True)) for row in found.tolist()] for found in runs]
            best = [None if b is None else dict(zip(names, b, strict=True)) for b in map(strongest, runs)]
            collapsed = [b" ".join(collapse(words, found)) for words, found in zip(texts, runs, strict=True)]
            columns = [batch.column(0), pa.array(listed, pa.list_(_RUN_TYPE)), pa.array(best, _RUN_TYPE), pa.array(collapsed, pa.binary())]
            yield pa.record_batch(columns, names=["doc_id", "runs", "best", "collapsed"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    kinds = [rows.schema["doc_id"], T.StructField("runs", T.ArrayType(_RUN)), T.StructField("best", _RUN)]
    found = rows.mapInArrow(run, T.StructType([*kinds, T.StructField("collapsed", T.BinaryType())]))
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))
