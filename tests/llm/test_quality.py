import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeglass.llm import quality
from tradeglass.llm.queries import QUERIES

from .conftest import AWKWARD

GOOD = ["the river runs to the sea and the town sleeps", "a letter came in the morning with news of home", "she walked along the road to the market"]
BAD = ["buy buy buy buy now now now", "$$$ win ### cash ### $$$", "CLICK!!! HERE!!! NOW!!!"]


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        words = (GOOD if good else BAD)[i % 7 % 3].split()
        rows.append((i, " ".join(words[j % len(words)] for j in range(i % 5, i % 5 + 12 + i % 9)) + f" {i}"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(llm, documents):
    rows, labels = corpus()
    docs = documents(rows)
    table = llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = quality.score(docs, quality.train(docs, table)).collect()
    want = {i: q for i, q, _ in labels}
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in found)


def test_held_out_labels_change_nothing(llm, documents):
    rows, labels = corpus(200)
    docs = documents(rows)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q, t) for i, q, t in labels]
    models = [quality.train(docs, llm.createDataFrame(x, "doc_id bigint, quality int, toxic int")) for x in (labels, flipped)]
    assert np.array_equal(models[0], models[1])


def test_every_labelled_row_is_learned_from(llm, documents):
    """Blocks of 40 rows: the rows that come last by the hash of their id count too, and so does each block."""
    rows, labels = corpus()
    docs, table = documents(rows), llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    last = [r.doc_id for r in table.filter(~quality.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id").desc()).limit(30).collect()]
    whole = quality.train(docs, table, rows=40)
    assert np.array_equal(whole, quality.train(docs, table, rows=40))
    assert not np.array_equal(whole, quality.train(docs, table.filter(~F.col("doc_id").isin(last)), rows=40))
    want = {i: q for i, q, _ in labels}
    held = quality.score(docs, whole).filter("held_out").collect()
    assert sum(r.predicted == want[r.doc_id] for r in held) >= 0.95 * len(held)


def test_copies_of_one_id_are_several_blocks(llm, documents):
    rows, labels = corpus(60)
    docs, table = documents([*rows, *[(7, f"now now now {i}") for i in range(90)]]), llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = quality.train(docs, table, rows=20)
    assert np.isfinite(model).all() and quality.score(docs, model).count() == 150


def test_dual_coordinate_descent_finds_the_least_loss(monkeypatch):
    monkeypatch.setattr(quality, "_EPOCHS", 500)
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 30, 12)) for _ in range(60)]
    labels = np.array([int(5 in row) for row in rows])
    scale = np.ones(40)
    weights, constant = quality.descend(rows, labels, scale)

    def loss(w, b):
        m = np.array([quality._size(r) * w[r].sum() + b for r in rows]) * np.where(labels == 1, 1, -1)
        return 0.5 * ((w**2).sum() + b * b) + quality._COST * np.maximum(0, 1 - m).sum()

    best = loss(weights, constant)
    for _ in range(300):
        assert loss(weights + rng.normal(0, 0.02, 40), constant + rng.normal(0, 0.02)) >= best - 0.01


def test_labels_of_one_kind_or_none(llm, documents):
    docs = documents(AWKWARD)
    schema = "doc_id bigint, quality int, toxic int"
    none = quality.score(docs, quality.train(docs, llm.createDataFrame([], schema))).collect()
    assert {r.score for r in none} == {0.5} and len(none) == len(AWKWARD)
    odd = [(1, 1, 0), (1, 0, 0), (6, 7, 0), (7, None, 0), (None, 1, 0), (9, 1, 0), (8, 1, 0), (2, 1, 0)]
    one = quality.score(docs, quality.train(docs, llm.createDataFrame(odd, schema))).collect()
    assert len({r.score for r in one}) == 1 and one[0].score > 0.5


def test_accepted_and_empty_table(llm, documents):
    rows, labels = corpus(300)
    docs, table = documents(rows), llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    kept = quality.accepted(docs, table)
    scored = {r.doc_id: r.predicted for r in quality.score(docs, quality.train(docs, table)).collect()}
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, p in scored.items() if p)
    assert quality.score(documents([]), quality.fit([], np.zeros(0, int))).count() == 0


@pytest.mark.parametrize("text", [None, b"", b"a", b"ab"])
def test_short_texts(text):
    assert len(quality.NGrams().of(text)) <= 1


def test_long_text_is_hashed_in_windows(monkeypatch):
    text = b"some words here " * 200
    whole = quality.NGrams().of(text)
    monkeypatch.setattr(quality, "_WINDOW", 64)
    assert np.array_equal(whole, quality.NGrams().of(text))


def test_query(llm):
    found = QUERIES["op2_quality"](llm, "/root/testdata/sf0.1")
    labels = llm.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = found.filter("held_out").join(labels, "doc_id").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.98 * len(held)
    assert found.count() == 10_000
