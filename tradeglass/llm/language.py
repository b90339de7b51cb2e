"""The language of a text by rank-order profiles of n-grams.

A text is lower-cased and cut into runs of letters, each with a blank before and after it; its n-grams are the runs of one to
three characters that hold no blank inside.  A profile is the list of the ``size`` most frequent n-grams, most
frequent first, ties by code points.  Each language's profile comes from the whole texts of all its learning
rows; counts are added up per task first, so a language may have any share of the rows.  A document goes
to the language whose profile is the nearest to its own: the sum, over the document's n-grams, of the ranks
that an n-gram is out of place, or ``size`` where the language does not list it; ties go to the smaller name.

The score is 1 minus that sum over its greatest value: 1 for a text that is in the order of the profile, 0 for one
that shares no n-gram with it.

Cases: rows without a language or without an id are not learned from.  A text that is null or has no letter is ``und``
with score 0, and so is every text if no language could be learned.  Rows that repeat an id are counted and
predicted each.  A very long text is counted in pieces; memory is some ten bytes a character of it.  Other
columns are not read; an empty table gives an empty result.  The profiles, ``size`` n-grams a language, go
through the driver and to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeglass.llm.common import stage

SIZE = 400
UNKNOWN = "und"
# Of the rows, those whose crc32(id) leaves this remainder are held out.
FOLDS, HELD = 5, 0
_LONGEST = 3
# Characters that are counted at a time, and distinct n-grams of a language that a task holds before it sends them on.
_PIECE = 1 << 20
_HELD_GRAMS = 1 << 20
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_BLANK = 32


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text, as numbers of 21 bits a character in order, and how often each comes."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    total = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(points), _PIECE):
        piece = points[at : at + _PIECE + _LONGEST - 1].astype(np.int64)
        own = min(_PIECE, len(points) - at)
        one = piece[:own]
        two = one[: len(piece) - 1] << 21 | piece[1 : own + 1]
        inner = piece[1 : own + 1] != _BLANK
        three = (two << 21)[: len(piece) - 2] | piece[2 : own + 2]
        counted = np.unique(np.concatenate((one[one != _BLANK], two, three[inner[: len(three)]])), return_counts=True)
        total = _added(total, counted) if len(total[0]) else counted
    return total


def _added(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    return codes, np.bincount(where, np.concatenate((a[1], b[1]))).astype(np.int64)


def spelled(code: int) -> str:
    """The n-gram that a number stands for."""
    return "".join(chr(part) for shift in (42, 21, 0) if (part := code >> shift & 0x1FFFFF))


def _most(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by code points."""
    return codes[np.argsort(-counts, kind="stable")[:size]]


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of (lang, text), added up per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows(lang: str) -> pa.RecordBatch:
            codes, counts = held.pop(lang)
            return pa.record_batch([pa.array([lang] * len(codes), pa.string()), codes, counts], names=["lang", "gram", "n"])

        for batch in batches:
            parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts.setdefault(lang, []).append(grams(text))
            for lang, counted in parts.items():
                if lang in held:
                    counted.append(held[lang])
                codes, where = np.unique(np.concatenate([c for c, _ in counted]), return_inverse=True)
                held[lang] = codes, np.bincount(where, np.concatenate([n for _, n in counted]), len(codes)).astype(np.int64)
            while sum(len(codes) for codes, _ in held.values()) > _HELD_GRAMS:
                yield rows(max(held, key=lambda name: len(held[name][0])))
        for lang in list(held):
            yield rows(lang)

    return docs.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The profiles (lang, rank from 0, gram) from the rows where ``learn`` holds."""
    rows = docs.filter(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counted = _counts(rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")))
    # Only the first ``size`` of each partition reach the exchange of the window.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)
    return stage(ranked.select("lang", (F.col("rank") - 1).alias("rank"), "gram"), "language-profiles")


class Profiles:
    """The ranks of all listed n-grams in every language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.names = sorted({lang for lang, _, _ in rows})
        self.codes = np.unique(np.array([gram for _, _, gram in rows], dtype=np.int64))
        # One row more, for n-grams that no language lists.
        self.ranks = np.full((len(self.codes) + 1, len(self.names)), -1, np.int32)
        column = {name: i for i, name in enumerate(self.names)}
        for lang, rank, gram in rows:
            self.ranks[np.searchsorted(self.codes, gram), column[lang]] = rank

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language of a text, and the score."""
        own = _most(*grams(text or ""), self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, own)
        found = self.codes[np.minimum(at, len(self.codes) - 1)] == own
        ranks = self.ranks[np.where(found, at, len(self.codes))]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.names[best], 1 - int(apart[best]) / (self.size * len(own))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is held out; one without an id is not, though it is not learned from either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def predict(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    model = Profiles([tuple(row) for row in profiles.select("lang", "rank", "gram").collect()], size)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.nearest(text) for text in batch.column(2).to_pylist()]
            columns = [pa.array([name for name, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]
            yield pa.record_batch([*batch.columns[:2], *columns], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def languages(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Learn from the rows that are not held out, and predict all: doc_id, held_out, lang_pred, score."""
    learn = F.col("doc_id").isNotNull() & ~held_out()
    return predict(docs, train(docs, learn, size=size), size=size)
