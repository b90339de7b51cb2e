import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from tradeglass.llm import packing, word_bpe
from tradeglass.llm.packing import Index, inverse_frequency, pack
from tradeglass.llm.queries import QUERIES
from tradeglass.llm.word_bpe import WordBPE

from .conftest import AWKWARD, small

PATH = public.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def check(rows, pieces, tokenizer, window=2048):
    wanted = defaultdict(list)
    for i, t in rows:
        wanted[i].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])
    by_doc = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    assert set(by_doc) == set(wanted)
    for i, own in by_doc.items():
        texts = wanted[i]
        assert sum(p.length for p in own) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                ids = texts[0][at : at + p.length]
                assert p.start == at and p.doc_tokens == len(texts[0]) and p.length == len(ids) > 0
                assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
                at += p.length
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0


def test_terms_of_documents_are_made_once(llm, documents, monkeypatch):
    """The ranges are placed by rows that are written, not by the terms of all rows made once more."""
    staged = []
    monkeypatch.setattr(packing, "stage", lambda df, name, own=packing.stage: staged.append(df.columns) or own(df, name))
    pack(documents([(i, f"word{i % 7} other words {i}") for i in range(40)]), PATH).count()
    assert ["doc_id", "ids", "term"] in staged
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 1 << 16, n).astype("<u2") for n in (1, 300, 2, 5_000)] + [np.full(9, 65_535, "<u2")]
    token, owner, n = packing._distinct(docs)
    order = np.argsort(owner, kind="stable")
    for a, b in zip(packing._terms_by_document(docs), (token[order], owner[order], n[order]), strict=True):
        assert np.array_equal(a, b)


def test_words_encode_like_the_tokenizer(tokenizer):
    random.seed(3)
    bpe = WordBPE(open(PATH).read())
    letters = "aB \n\t é'S't1２ 　\xa0,.!\x1c\x85日本ßÄİΣςŸ½ª́e<|>"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 14))) for _ in range(4_000)]
    for text in [*texts, "<|endoftext|>", "I'LL we'Ve", "é" * 300]:
        assert np.frombuffer(bpe.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_worker_keeps_one_bounded_table(tokenizer, monkeypatch):
    """Words and the parts of words share a table: what a worker keeps does not grow with the words it meets."""
    monkeypatch.setattr(word_bpe, "CACHED", 50)
    bpe = WordBPE(open(PATH, encoding="utf-8").read())
    words = [f"{kind}{chr(97 + i % 26)}{chr(97 + i // 26)}{mark}" for i in range(300) for kind in ("ka", "Vé") for mark in ("", ",", "'s")]
    text = " ".join(words + words)
    assert np.frombuffer(bpe.encode(text), "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    tables = [table for table in vars(bpe).values() if hasattr(table, "older")]
    assert sum(len(table) + len(table.older) for table in tables) <= 2 * 50 + 8


def test_awkward_rows(awkward, tokenizer):
    check(AWKWARD, pack(awkward, PATH).collect(), tokenizer)


def test_query(llm, tokenizer):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    check(rows, QUERIES["op7_packing"](llm, "/root/testdata/sf0.001").collect(), tokenizer)


def test_blocks_carry_on(llm, documents, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_DOCS", 5)
    rows = [(i, f"topic{i % 3} " * (i % 40 + 1) + f"own {i}") for i in range(120)]
    check(rows, pack(documents(rows), PATH, window=64).collect(), tokenizer, 64)


def test_index_scores_like_bm25():
    random.seed(1)
    docs = [np.array([random.randint(1, 30) for _ in range(random.randint(1, 40))], dtype="<u2") for _ in range(25)]
    counts = np.zeros(1 << 16, np.int64)
    for d in docs:
        counts[np.unique(d)] += 1
    idf = inverse_frequency(counts, len(docs))
    mean = sum(map(len, docs)) / len(docs)
    found = Index(docs, idf, mean).scores(np.array([3, 7, 9]))
    for d, score in zip(docs, found, strict=True):
        want = 0.0
        for t in (3, 7, 9):
            n = int((d == t).sum())
            want += float(idf[t]) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(d) / mean))
        assert abs(score - want) < 1e-4


def test_neighbours_share_a_window(documents):
    rows = [(i, " ".join([f"alpha{i % 4}beta"] * 30) + f" {i}") for i in range(64)]
    pieces = pack(documents(rows), PATH, window=512).collect()
    topics = defaultdict(set)
    for p in pieces:
        topics[p.sequence_id].add(p.doc_id % 4)
    assert sum(len(t) for t in topics.values()) / len(topics) < 2


def test_empty_table_and_ids(documents, tokenizer):
    assert pack(documents([]), PATH).count() == 0
    piece = pack(documents([(1, "hello world")]), PATH, with_ids=True).orderBy("start").collect()
    ids = [i for p in piece for i in np.frombuffer(bytes(p.ids), "<u2").tolist()]
    assert ids == tokenizer.encode("hello world", add_special_tokens=False).ids + [1]
