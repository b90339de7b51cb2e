import random
import re

import xxhash
from pyspark.sql import functions as F

from .conftest import AWKWARD, small

from tradeglass.llm.graph import components
from tradeglass.llm.hamming import close_pairs, masks
from tradeglass.llm.near_dup import fingerprint, near_duplicates, representatives
from tradeglass.llm.queries import QUERIES


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def expected(rows):
    prints = {t: slow_print(t) for _, t in rows}
    values = sorted(set(prints.values()))
    root = {v: v for v in values} | slow_components(
        (a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= 2
    )
    first = {}
    for i, t in rows:
        if i is not None:
            first[root[prints[t]]] = min(i, first.get(root[prints[t]], i))
    return sorted(str((i, f"{prints[t]:016x}", first.get(root[prints[t]]))) for i, t in rows)


def test_awkward_rows(awkward):
    assert sorted(str(tuple(r)) for r in near_duplicates(awkward).collect()) == expected(AWKWARD)


def test_query(llm):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    assert sorted(str(tuple(r)) for r in QUERIES["op1_simhash"](llm, "/root/testdata/sf0.001").collect()) == expected(rows)


def test_fingerprint_of_a_long_text():
    text = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
    assert fingerprint(text.encode()) == slow_print(text)


def test_pairs_in_crowded_buckets(llm):
    random.seed(2)
    values = {random.getrandbits(64) for _ in range(60)}
    base = random.getrandbits(64)
    values |= {base ^ (1 << i) ^ (1 << j) for i in range(14) for j in range(14)} | {base}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = llm.createDataFrame([(v,) for v in signed], "fp bigint")
    found = {tuple(r) for r in close_pairs(frame).collect()}
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}


def test_masks_cover_all_choices():
    assert len(masks(5, 2)) == 10 and all(m.bit_count() >= 38 for m in masks(5, 2))


def test_components_of_paths_and_hubs(llm):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 201), (201, 200), (-5, 159)]
    frame = llm.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {k: v for k, v in slow_components(links).items()}
    assert components(frame.filter("a > 999")).count() == 0


def test_representatives(awkward, documents):
    kept = representatives(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({int(x.split(", ")[2].rstrip(")")) for x in expected(AWKWARD)})
    nameless = documents([(None, "a b c d"), (None, "a b c d"), (None, "other words entirely here")])
    assert representatives(nameless).count() == 2


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert representatives(documents([])).count() == 0
    assert "component_id" in near_duplicates(documents([]).withColumn("extra", F.lit(1))).columns
