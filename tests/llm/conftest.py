from __future__ import annotations

import pytest

from tradeglass.llm.common import ready

LONG = " ".join(f"word{i}" for i in range(3_000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
# Nulls, empty, blank and long texts, copies, repeated rows, a null id.
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, LONG + " end"),
    (8, "intro words " + PASSAGE + " outro\nsecond line of words that is only here"),
    (9, PASSAGE),
    (10, "Ünïcode ẞ 日本語 token = 'abcdefgh12345678'   x"),
    (None, "the quick brown fox jumps over the lazy dog near the old river bank today"),
    (None, None),
    (11, "one\n\ntwo words\r\nTHE QUICK BROWN FOX jumps over the lazy dog near the old river bank today\n"),
]


@pytest.fixture
def llm(spark):
    return ready(spark)


@pytest.fixture
def documents(llm):
    """A table of documents from (id, text), with columns whose names the operators use themselves."""

    def build(rows: list[tuple]):
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, fp string, ids string, "
            "digest string, first string, shard string, label int, line string, spans string, term string"
        )
        return llm.createDataFrame([(i, t, "en", "s", len(t or ""), *["x"] * 6, 1, *["x"] * 3) for i, t in rows], schema)

    return build


@pytest.fixture
def awkward(documents):
    return documents(AWKWARD)


def small(spark, name: str):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
