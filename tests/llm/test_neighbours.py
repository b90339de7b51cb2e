import numpy as np

from tradeglass.llm import neighbours
from tradeglass.llm.neighbours import nearest
from tradeglass.llm.queries import QUERIES

from .conftest import small


def exact(rows, every, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    good = [(i, v) for i, v in good if len(v) == len(good[0][1])]
    made = {}
    for i, v in good:
        if i % every == 0:
            made[i] = sorted(((-float((v * w).sum()), j) for j, w in good if j != i))[:k]
    return made


def recall(found, want):
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    total = sum(len(w) for w in want.values())
    return sum(len(got.get(q, set()) & {j for _, j in w}) for q, w in want.items()) / total


def test_query_recall_and_scores(llm):
    rows = [(r.vec_id, r.embedding) for r in small(llm, "embeddings").collect()]
    found = QUERIES["op6_neighbours"](llm, "/root/testdata/sf0.001").collect()
    want = exact(rows, 20, 20)
    assert recall(found, want) >= 0.9
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for r in found:
        assert abs(float(vectors[r.query_id] @ vectors[r.vec_id]) - r.score) < 1e-12 and r.query_id != r.vec_id
    for q in want:
        own = sorted((r.rank, -r.score, r.vec_id) for r in found if r.query_id == q)
        assert [x[0] for x in own] == list(range(1, 21)) and [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_awkward_vectors_and_copies(llm):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]
    rows += [(400, None), (420, [0.0] * 4), (440, [1.0, None, 0.0, 0.0]), (460, [float("nan"), 1.0, 1.0, 1.0]), (480, [1.0]), (481, [])]
    rows += [(500, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    frame = llm.createDataFrame([(i, v, "x") for i, v in rows], "vec_id bigint, embedding array<float>, leaf string")
    found = nearest(frame, k=5, recall=1.0).collect()
    want = exact([r for r in rows if r[0] is not None], 20, 5)
    assert set(want) == {r.query_id for r in found}
    hits = recall(found, want)
    assert hits >= 0.9
    # All copies score the same: the smallest ids win, without the query itself.
    own = sorted((r.rank, r.vec_id) for r in found if r.query_id == 120)
    if all(r.score == 1.0 for r in found if r.query_id == 120):
        assert [v for _, v in own] == [100, 101, 102, 103, 104]


def test_few_candidates_and_empty_table(llm):
    schema = "vec_id bigint, embedding array<float>"
    assert nearest(llm.createDataFrame([], schema)).count() == 0
    assert nearest(llm.createDataFrame([(20, [1.0, 2.0])], schema)).count() == 0
    few = nearest(llm.createDataFrame([(20, [1.0, 2.0]), (21, [1.0, 0.0]), (22, [2.0, 0.0])], schema)).collect()
    assert sorted((r.rank, r.vec_id, r.score) for r in few) == [(1, 22, 2.0), (2, 21, 1.0)]


def test_cells_are_sliced(llm, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL_VECTORS", 7)
    monkeypatch.setattr(neighbours, "CELL_QUERIES", 3)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3).astype(np.float32)]) for i in range(120)]
    found = nearest(llm.createDataFrame(rows, "vec_id bigint, embedding array<float>"), every=5, k=4, recall=1.0).collect()
    want = exact(rows, 5, 4)
    assert recall(found, want) >= 0.9 and len(found) == sum(len(w) for w in want.values())
