import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from tradeglass.llm import resampling
from tradeglass.llm.queries import QUERIES

from .conftest import AWKWARD, small


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return found, [" ".join(found[i : i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]


def expected(rows, target, buckets=10_000):
    made = [features(t) for _, t in rows]
    corpus = Counter(crc32(f.encode()) % buckets for _, fs in made for f in fs)
    aim = Counter(crc32(f.encode()) % buckets for t in target for f in features(t)[1])
    n, m = sum(corpus.values()), sum(aim.values())
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (n + buckets) / ((corpus[b] + 1) * (m + buckets)))) for b in range(buckets)]
    result = []
    for (i, _), (found, fs) in zip(rows, made, strict=True):
        weight = sum(gain[crc32(f.encode()) % buckets] for f in fs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        result.append([i, len(fs), weight, score, None, len(found)])
    able = sorted((r for r in result if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 5 * len(able) // 100], 1):
        row[4] = rank
    return sorted(str(tuple(r[:5])) for r in result)


def rows_of(frame):
    assert frame.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    return sorted(str(tuple(r)) for r in frame.collect())


def test_query(llm):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    target = [r.text for r in small(llm, "benchmark").collect()]
    found = rows_of(QUERIES["op11_resampling"](llm, "/root/testdata/sf0.001"))
    assert found == expected(rows, target)
    assert sum("None" not in row for row in found) == 5 * sum(len(features(t)[0]) >= 20 for _, t in rows) // 100


def test_awkward_rows(llm, awkward):
    target = llm.createDataFrame([(None,), ("",), ("words that is\nonly here",)], "text string")
    assert rows_of(resampling.resample(awkward, target)) == expected(AWKWARD, [None, "", "words that is\nonly here"])


@pytest.mark.parametrize("frequent", [1, 8, 4_096])
def test_repeated_lines_and_ties(llm, documents, monkeypatch, frequent):
    monkeypatch.setattr(resampling, "FREQUENT", frequent)
    random.seed(frequent)
    pool = ["", "a", "B b", "one two THREE", "…é 漢字", "-", "x\r", " ".join(f"w{i}" for i in range(30))]
    rows = [(i // 2, "\n".join(random.choices(pool, weights=[1, 2, 2, 2, 1, 1, 1, 9], k=random.randint(0, 8)))) for i in range(80)]
    target = llm.createDataFrame([(i, t) for i, t in rows[:9]], "item_id bigint, text string")
    assert rows_of(resampling.resample(documents(rows), target)) == expected(rows, [t for _, t in rows[:9]])


def test_all_may_be_drawn(llm, documents):
    rows = [(i, f"{'word ' * 25}{i % 3}") for i in range(40)]
    target = llm.createDataFrame([("word",)], "text string")
    found = resampling.resample(documents(rows), target, percent=100, least_words=1).collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 41))
    order = sorted(found, key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in order] == sorted((-r.score, r.doc_id) for r in order)


def test_a_target_draws_what_is_like_it(llm, documents):
    near, far = "the cat sat on the mat and slept all day long ", "buy cheap pills now best price online order fast "
    rows = [(i, (near if i % 4 == 0 else far) * (3 + i % 3)) for i in range(200)]
    target = llm.createDataFrame([(near,)] * 500, "text string")
    drawn = resampling.resample(documents(rows), target, percent=20).filter("rank is not null").collect()
    assert len(drawn) == 40 and all(r.doc_id % 4 == 0 for r in drawn)


def test_features_of_lines_and_crossings_are_those_of_the_text():
    random.seed(3)
    for _ in range(300):
        text = "".join(random.choices(["a", "b", " ", "\n", "é", "-"], k=random.randint(0, 30)))
        lines = [resampling.words(line) for line in text.encode().split(b"\n")]
        found = [int(b) for line in lines for b in resampling.line_buckets(line)] + resampling.crossing_buckets(lines)
        assert sorted(found) == sorted(crc32(f.encode()) % 10_000 for f in features(text)[1])


def test_empty_tables(llm, documents):
    target = llm.createDataFrame([("a b c",)], "text string")
    assert rows_of(resampling.resample(documents([]), target)) == []
    rows = [(1, "a b c"), (2, "d " * 30)]
    assert rows_of(resampling.resample(documents(rows), target.filter("false"))) == expected(rows, [])


def test_no_line_is_in_one_task(llm, documents):
    target = llm.createDataFrame([("a b c",)], "text string")
    rows = documents([(i, "same line\n" * 3 + f"own {i}") for i in range(50)])
    weighed = resampling.weights(rows, target)
    assert weighed.filter(F.col("n_features") != 21).count() == 0
    assert weighed.select("weight").distinct().count() > 0
