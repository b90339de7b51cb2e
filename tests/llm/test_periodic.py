import hashlib
import random
import re
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeglass.llm import periodic
from tradeglass.llm.queries import QUERIES, with_periods

from .conftest import AWKWARD, small


def slow_runs(words, exponent=4, least=6):
    """All maximal stretches of every period, by comparing words; those with a smaller period go."""
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                part = words[i : i + length]
                if not any(all(part[k] == part[k + r] for k in range(length - r)) for r in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), crc32(str(i).encode())
    if i is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def expected(rows):
    result = []
    for i, text in rows:
        words = planted(i, text)
        runs = slow_runs(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, kept)]
        result.append(str((i, len(runs), *figures, *digests)))
    return sorted(result)


def test_query(llm):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").filter("n_chars < 20000").collect()]
    frame = QUERIES["op12_periodic"](llm, "/root/testdata/sf0.001")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert frame.columns == names
    kinds = dict(frame.dtypes)
    assert all(kinds[n] == "bigint" for n in names[:6]) and all(kinds[n] == "string" for n in names[6:])
    ids = {i for i, _ in rows}
    assert sorted(str(tuple(r)) for r in frame.collect() if r.doc_id in ids) == expected(rows)
    assert frame.count() == small(llm, "documents").count()


def test_awkward_rows(awkward):
    found = periodic.periodic_runs(awkward, rewrite=with_periods)
    want = {(i, tuple(slow_runs(planted(i, t)))) for i, t in AWKWARD}
    assert {(r.doc_id, tuple(tuple(x) for x in r.runs)) for r in found.collect()} == want
    assert found.count() == len(AWKWARD)
    plain = periodic.periodic_runs(awkward).filter("doc_id = 9").first()
    assert plain.runs == [] and plain.best is None and plain.collapsed == " ".join(f"shared{i}" for i in range(60))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=4), st.sampled_from([2, 3, 4]), st.sampled_from([2, 6]))
def test_against_brute_force(texts, exponent, least):
    texts = [[b"%d" % w for w in t] for t in texts]
    found = [list(map(tuple, r.tolist())) for r in periodic.find(texts, exponent, least)]
    assert found == [slow_runs(t, exponent, least) for t in texts]


@pytest.mark.parametrize("chunk", [3, 1 << 18])
def test_planted_periods(monkeypatch, chunk):
    monkeypatch.setattr(periodic, "_CHUNK", chunk)
    random.seed(5)
    texts = []
    for _ in range(150):
        n, p = random.randint(1, 90), random.randint(1, 12)
        a = random.randrange(n)
        words = [b"%d" % random.randint(0, random.choice([1, 3, 50])) for _ in range(n)]
        texts.append([words[k] if k < a else words[a + (k - a) % p] if a + (k - a) % p < n else words[k] for k in range(n)])
    assert [list(map(tuple, r.tolist())) for r in periodic.find(texts)] == [slow_runs(t) for t in texts]


def test_grammar_agrees_like_the_words():
    rng = np.random.default_rng(7)
    body = np.concatenate([np.tile(rng.integers(0, 3, 7), 20), rng.integers(0, 2, 150), np.zeros(60, np.int64)])
    symbols = np.concatenate(([10], body, [11]))
    grammar = periodic.Grammar(symbols)
    x, y = (a.ravel() for a in np.triu_indices(len(symbols), 1))
    right, left = grammar.agreeing(x, y, True), grammar.agreeing(x, y, False)
    for k in range(0, len(x), 37):
        i, j = x[k], y[k]
        r = next(m for m in range(len(symbols)) if symbols[i + m] != symbols[j + m])
        s = next(m for m in range(len(symbols)) if symbols[i - m] != symbols[j - m])
        assert (right[k], left[k]) == (r, s)


@pytest.mark.parametrize("words", [[b"a"] * 50_000, [b"a", b"b", b"c"] * 20_000])
def test_a_long_text_of_one_period(words):
    q = len(set(words))
    runs = periodic.find([words])[0]
    assert runs.tolist() == [[0, len(words), q]]
    assert periodic.collapse(words, runs) == words[:q] and periodic.strongest(runs) == (0, len(words), q)


def test_equal_strength_takes_the_first():
    words = [b"x"] * 8 + [b"p", b"q"] * 8 + [b"y"] * 8
    assert periodic.strongest(periodic.find([words])[0]) == (0, 8, 1)


def test_empty_table(documents):
    frame = periodic.periodic_runs(documents([]).withColumn("runs", F.lit(1)))
    assert frame.count() == 0 and frame.columns == ["doc_id", "runs", "best", "collapsed"]
