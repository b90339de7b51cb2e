from collections import Counter
from zlib import crc32

import pytest
import regex
from pyspark.sql import functions as F

from tradeglass.llm import language
from tradeglass.llm.queries import QUERIES

from .conftest import AWKWARD, small


def slow_grams(text):
    found = Counter()
    for word in regex.findall(r"\p{L}[\p{L}\p{M}]*", (text or "").lower()):
        padded = f" {word} "
        found.update(g for k in (1, 2, 3) for i in range(len(padded) - k + 1) if " " not in (g := padded[i : i + k])[1:-1] and g != " ")
    return found


def first(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda c: (-c[1], number(c[0])))][:size]


def number(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def expected(rows, size=400):
    counts = {}
    for i, text, lang in rows:
        if i is not None and lang is not None and text is not None and crc32(str(i).encode()) % 5:
            counts.setdefault(lang, Counter()).update(slow_grams(text))
    profiles = {lang: {g: r for r, g in enumerate(first(c, size))} for lang, c in sorted(counts.items()) if c}
    result = []
    for i, text, _ in rows:
        own = first(slow_grams(text), size)
        held = i is not None and crc32(str(i).encode()) % 5 == 0
        if not own or not profiles:
            result.append((i, held, "und", 0.0))
            continue
        apart = {lang: sum(abs(r - p[g]) if g in p else size for r, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(apart, key=lambda name: (apart[name], name))
        result.append((i, held, best, 1 - apart[best] / (size * len(own))))
    return sorted(map(str, result))


def test_query(llm):
    rows = [(r.doc_id, r.text, r.lang) for r in small(llm, "documents").collect()]
    frame = QUERIES["op13_language"](llm, "/root/testdata/sf0.001")
    assert frame.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert sorted(str(tuple(r)) for r in frame.collect()) == expected(rows)


def test_held_out_accuracy(llm):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out and lang_pred <> 'und'")
    right, total = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 150 and right >= 0.97 * total


@pytest.mark.parametrize("held", [50, 1 << 20])
def test_awkward_rows(awkward, monkeypatch, held):
    monkeypatch.setattr(language, "_HELD_GRAMS", held)
    name = F.when(F.col("doc_id") == 6, None).when(F.col("doc_id") % 2 == 0, "").otherwise("x")
    docs = awkward.withColumn("lang", name)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    found = [tuple(r) for r in language.languages(docs).collect()]
    assert sorted(map(str, found)) == expected(rows) and len(found) == len(AWKWARD)


def test_held_out_labels_change_nothing(documents):
    rows = [(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * (1 + i % 3)) for i in range(60)]
    lang = F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de")
    docs = documents(rows).withColumn("lang", lang)
    wrong = docs.withColumn("lang", F.when(language.held_out(), F.lit("zz")).otherwise(lang))
    a, b = (sorted(map(tuple, language.languages(d).collect())) for d in (docs, wrong))
    assert a == b and all(r[2] == ("en" if r[0] % 2 else "de") for r in a)


def test_ties_go_to_the_smaller_name(documents):
    docs = documents([(i, "same words here") for i in range(20)]).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "b").otherwise("a"))
    assert {(r.lang_pred, r.score) for r in language.languages(docs).collect()} == {("a", 1.0)}


def test_text_without_letters_and_nothing_learned(documents):
    rows = [(1, "12 34 !?"), (2, None), (3, ""), (4, "words")]
    found = language.languages(documents(rows).withColumn("lang", F.lit(None).cast("string")))
    assert {(r.lang_pred, r.score) for r in found.collect()} == {("und", 0.0)}


def test_grams_in_pieces(monkeypatch):
    text = "Über die Brücke — naïve éte 日本語 " * 50 + "x" * 300
    whole = dict(zip(*(a.tolist() for a in language.grams(text)), strict=True))
    assert {language.spelled(c): n for c, n in whole.items()} == slow_grams(text)
    monkeypatch.setattr(language, "_PIECE", 7)
    assert dict(zip(*(a.tolist() for a in language.grams(text)), strict=True)) == whole


def test_empty_table(documents):
    assert language.languages(documents([])).count() == 0
