"""The numbered queries, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeglass.llm import (
    byte_bpe,
    exact_dedup,
    fuzzy_lines,
    language,
    near_dup,
    neighbours,
    packing,
    periodic,
    quality,
    resampling,
    secret_scan,
    sharding,
    substrings,
)
from tradeglass.llm.common import ready, stage_path, table
from tradeglass.llm.oracle import LANGUAGE, PERIODIC, RESAMPLING


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(ready(spark), sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoded_digests(table(ready(spark), sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeats(table(ready(spark), sf_dir, "documents"), with_text=False)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(ready(spark), sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(ready(spark), sf_dir, "embeddings"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(ready(spark), sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.cleaned_lines(table(ready(spark), sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as the first batch of a new index."""
    ready(spark)
    index = exact_dedup.DigestIndex(spark, stage_path(spark, "digest-index"))
    return index.add(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(ready(spark), sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(ready(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_periods(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of the query: of some documents, by their id, the end repeats with a period that follows from it."""
    h = crc32(b"" if doc_id is None else b"%d" % doc_id)
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(table(ready(spark), sf_dir, "documents"), rewrite=with_periods)
    listed = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(listed, lambda line: F.concat(line, F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(ready(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_substrings": op4_substrings,
    "op5_secrets": op5_secrets,
    "op6_neighbours": op6_neighbours,
    "op7_packing": op7_packing,
    "op8_fuzzy_lines": op8_fuzzy_lines,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_sharding": op10_sharding,
    "op11_resampling": op11_resampling,
    "op12_periodic": op12_periodic,
    "op13_language": op13_language,
}

ORACLE: dict[str, str] = {
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op11_resampling": RESAMPLING,
    "op12_periodic": PERIODIC,
    "op13_language": LANGUAGE,
}
