import hashlib
import random

import pytest

from tradeglass.llm import substrings
from tradeglass.llm.queries import QUERIES

from .conftest import AWKWARD, small


def expected_rows(rows):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, own in words:
        if i is not None:
            for a in range(len(own) - 49):
                window = tuple(own[a : a + 50])
                first[window] = min(i, first.get(window, i))
    made = []
    for i, own in words:
        gone = bytearray(len(own))
        for a in range(len(own) - 49):
            if i is not None and first[tuple(own[a : a + 50])] < i:
                gone[a : a + 50] = b"\1" * 50
        kept = b" ".join(w for w, g in zip(own, gone, strict=True) if not g)
        made.append((i, len(own), sum(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return made


def expected(rows):
    return sorted(map(str, expected_rows(rows)))


def overlapping():
    random.seed(4)
    passages = [[f"p{k}w{random.randint(0, 40)}" for _ in range(n)] for k, n in enumerate((49, 50, 51, 80, 200))]
    rows = []
    for i in range(60):
        words = []
        for _ in range(random.randint(0, 4)):
            words += [f"own{random.randint(0, 9999)}" for _ in range(random.randint(0, 60))]
            passage = random.choice(passages)
            cut = random.randint(0, 3)
            words += passage[cut:]
        rows.append((i % 55, " ".join(words) + (" twice" * 120 if i % 7 == 0 else "")))
    return rows


@pytest.mark.parametrize("group", [1_000, 3])
def test_against_brute_force(documents, monkeypatch, group):
    monkeypatch.setattr(substrings, "GROUP", group)
    rows = overlapping()
    found = substrings.without_repeats(documents(rows)).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(rows)


def test_awkward_rows(awkward):
    assert sorted(str(tuple(r)) for r in substrings.without_repeats(awkward).collect()) == expected(AWKWARD)


def test_query_and_empty_table(llm, documents):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    found = QUERIES["op4_substrings"](llm, "/root/testdata/sf0.001").collect()
    assert sorted(str(tuple(r)) for r in found) == sorted(str(x[:4]) for x in expected_rows(rows))
    assert substrings.without_repeats(documents([])).count() == 0


def test_texts_are_shuffled_once(llm, documents, tmp_path):
    documents(overlapping()).write.parquet(str(tmp_path / "docs"))
    llm.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = substrings.without_repeats(llm.read.parquet(str(tmp_path / "docs")), with_text=False)
        frame.collect()
        plan = frame._jdf.queryExecution().executedPlan().toString()
    finally:
        llm.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[plan.find("Final Plan") : plan.find("Initial Plan")]
    assert final.count("ReusedExchange") >= 1
