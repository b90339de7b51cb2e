"""Quality classifier: a linear support vector machine over n-grams scaled by Naive Bayes.

The features of a text are which byte n-grams it has, hashed to a fixed number of columns, and which n-grams
of one and the same word.  Each column is scaled by the logarithm of how much more often documents of label 1
have it than those of label 0, and each row by the root of its number of features, so that long texts weigh no
more than short ones.  Over these, a linear model with hinge loss is fitted by dual coordinate descent.  A logistic curve,
fitted to margins of rows that the model did not see, turns margins into scores from 0 to 1.

The model is learned from every labelled row that is not held out.  The rows are spread over blocks of some
``BLOCK_ROWS`` by a hash of their id; each block counts, and fits weights and curve, and the model is the mean of
those of the blocks, by their rows.  With ``BLOCK_ROWS`` rows or fewer there is one block.  All documents are scored.
Only labels and texts are learned from.

Cases: a null text counts as empty; an empty text has no n-grams and gets the score of the constant term.
A document that is labelled both ways, or with another value than 0 and 1, is not learned from.  Without
rows of both labels, every score is the share of label 1 among them (0.5 without any).  Rows that
repeat an id are scored each.  Only ids, texts and the label are read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeglass.llm.common import stage

# Rows that are fitted together, in one task.
BLOCK_ROWS = 12_000
# Models of blocks that are held at a time.
_MODELS = 16
SIZES = (2, 3, 4)
HASHED = 1 << 18
# Further columns: a word comes twice in a row, three times, and so on.
REPEATS = 8
COLUMNS = HASHED + REPEATS
ACCEPTED = 0.7
# Bytes that are hashed at a time.
_WINDOW = 1 << 20
# Counts added to each column before ratios are taken, cost of a margin that is missed, passes over the rows.
_SMOOTHING, _COST, _EPOCHS = 1.0, 1.0, 15
# One row in so many is kept from the model, to fit the curve.
_CURVE_ROWS = 4


def held_out(id_column: Column) -> Column:
    """Rows whose label is never learned from."""
    return F.coalesce(F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


class NGrams:
    """Distinct n-gram columns of texts."""

    def __init__(self, sizes: tuple[int, ...] = SIZES):
        self.bits, self.sizes = HASHED.bit_length() - 1, sizes
        self.flags = np.zeros(COLUMNS, bool)

    def of(self, text: bytes | None) -> np.ndarray:
        data = np.frombuffer(text or b"", np.uint8)
        words = (text or b"").split()
        same = bytes(map(operator.eq, words, words[1:]))
        for times in range(1, REPEATS + 1):
            if b"\1" * times not in same:
                break
            self.flags[HASHED + times - 1] = True
        for at in range(0, len(data), _WINDOW):
            part = data[at : at + _WINDOW + max(self.sizes) - 1].astype(np.uint32)
            for size in self.sizes:
                if len(part) < size:
                    continue
                gram = part[: len(part) - size + 1] + np.uint32(size)
                for k in range(1, size):
                    gram = gram * np.uint32(0x01000193) ^ part[k : len(part) - size + 1 + k]
                self.flags[(gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - self.bits)] = True
        found = np.flatnonzero(self.flags)
        self.flags[found] = False
        return found.astype(np.uint32)


def _size(row: np.ndarray) -> float:
    return 1 / math.sqrt(max(len(row), 1))


def log_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Per column the logarithm of its share in label 1 over its share in label 0."""
    shares = []
    for label in (1, 0):
        counts = np.full(COLUMNS, _SMOOTHING)
        for row, own in zip(rows, labels, strict=True):
            if own == label:
                counts[row] += 1
        shares.append(counts / counts.sum())
    return np.log(shares[0] / shares[1])


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights per column, already multiplied by the scale, and the constant term.  Dual coordinate
    descent: each row has a multiplier from 0 to the cost, which is set to its best value in turn."""
    weights, constant = np.zeros(len(scale)), 0.0
    square = scale * scale
    sign = np.where(labels == 1, 1.0, -1.0)
    sizes = [_size(row) for row in rows]
    norms = [size * size * square[row].sum() + 1.0 for row, size in zip(rows, sizes, strict=True)]
    multipliers = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(_EPOCHS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            row, size = rows[i], sizes[i]
            slack = sign[i] * (size * weights[row].sum() + constant) - 1.0
            best = min(max(multipliers[i] - slack / norms[i], 0.0), _COST)
            step = (best - multipliers[i]) * sign[i]
            if step:
                multipliers[i] = best
                weights[row] += step * size * square[row]
                constant += step
                moved = max(moved, abs(step))
        if moved < 1e-4 * _COST:
            break
    return weights, constant


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margin to probability, by Newton steps on smoothed targets."""
    ones = int((labels == 1).sum())
    high, low = (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2)
    target = np.where(labels == 1, high, low)
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * (b - [1.0, 0.0]))
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return max(float(b[0]), 1e-6), float(b[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights of the columns, then the offset, for ``log_odds``."""
    model = np.zeros(COLUMNS + 1)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        model[-1] = math.log(share / (1 - share))
        return model
    seen = np.arange(len(rows)) % _CURVE_ROWS != 0
    if len(set(labels[seen].tolist())) < 2:
        seen[:] = True
    learned = [row for row, own in zip(rows, seen, strict=True) if own]
    scale = log_ratios(learned, labels[seen])
    weights, constant = descend(learned, labels[seen], scale)
    unseen = ~seen if not seen.all() else seen
    margins = np.array([_size(row) * weights[row].sum() + constant for row, own in zip(rows, unseen, strict=True) if own])
    slope, offset = logistic(margins, labels[unseen])
    model[:-1], model[-1] = slope * weights, slope * constant + offset
    return model


def scores_of(texts: list[bytes | None], model: np.ndarray) -> np.ndarray:
    """The probability of label 1 for each text."""
    grams, offset = NGrams(), float(model[-1])
    rows = (grams.of(text) for text in texts)
    odds = np.array([_size(row) * float(model[row].sum(dtype=np.float64)) + offset for row in rows], dtype=np.float64)
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, label) of the labelled rows to learn from; rows of the held-out remainder are left out."""
    clear = labels.filter(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("doc_id"))
    once = clear.agg(F.min(label_col).alias("label"), F.max(label_col).alias("_high"))
    once = once.filter(F.col("label").isin(0, 1) & (F.col("label") == F.col("_high")))
    return once.select("doc_id", F.col("label").cast("int").alias("label"))


def _mean(models: list[np.ndarray]) -> np.ndarray:
    """The mean of models, each led by its number of rows, by these."""
    rows = sum(model[0] for model in models)
    return np.concatenate([[rows], sum(model[1:] * (model[0] / rows) for model in models)])


def train(docs: DataFrame, labels: DataFrame, rows: int = BLOCK_ROWS, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """The fitted model, of a block of about so many rows in each task.  The driver gets one model."""
    known = stage(learnable(labels, id_col), "quality-labels")
    blocks = max(1, -(-known.count() // rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.lit(None).cast("int").alias("label"))
    texts = texts.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # Texts and labels meet in partitions by id, so that texts are shuffled once, and each partition is a block.
    met = texts.withColumn("own", F.lit(True)).unionByName(known.withColumns({"text": F.lit(None).cast("binary"), "own": F.lit(False)}))
    met = met.repartition(blocks, "doc_id").withColumn("label", F.max("label").over(Window.partitionBy("doc_id")))
    placed = met.filter("own and label is not null").sortWithinPartitions("doc_id", "text").select("text", "label")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, models, found, own = NGrams(), [], [], []

        def block() -> None:
            model = fit(found, np.array(own))
            models[:] = [_mean([*models, np.concatenate([[len(found)], model])])]
            found.clear()
            own.clear()

        for batch in batches:
            for text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.append(grams.of(text))
                own.append(label)
                # Copies of one id share a partition; very many are several blocks.
                if len(found) == 4 * rows:
                    block()
        if found:
            block()
        context = TaskContext.get()
        number = context.partitionId() if context else 0
        for model in models:
            yield pa.record_batch([pa.array([number], pa.int64()), pa.array([model.astype("<f8").tobytes()])], names=["block", "model"])

    def averaged(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block", kind="stable")
        model = _mean([np.frombuffer(x, "<f8") for x in group["model"]])
        return pd.DataFrame({"block": [group["block"].iloc[0] // _MODELS], "model": [model.tobytes()]})

    schema = "block bigint, model binary"
    models = placed.mapInArrow(fitted, schema)
    while blocks > 1:
        models = models.groupBy(F.floor(F.col("block") / _MODELS)).applyInPandas(averaged, schema)
        blocks = -(-blocks // _MODELS)
    made = models.groupBy(F.lit(0).alias("all")).applyInPandas(averaged, schema).collect()
    return np.frombuffer(made[0]["model"], "<f8")[1:] if made else fit([], np.zeros(0, int))


def score(docs: DataFrame, model: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = scores_of(batch.column(1).to_pylist(), shared.value)
            yield pa.record_batch([batch.column(0), pa.array(made)], names=["doc_id", "score"])

    own = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scores, f"doc_id {own}, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPTED).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    model = train(docs, labels, text_col=text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model.astype(np.float32))

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(scores_of([(t or "").encode() for t in texts], shared.value))

    return docs.filter(scores(F.col(text_col)) >= ACCEPTED)
