"""From raw documents to packed training sequences: each stage works on what the one before it kept.

Every stage but the last returns the columns of documents; between stages the documents are written as Parquet
and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeglass.llm import fuzzy_lines, near_dup, packing, quality, secret_scan
from tradeglass.llm.common import ready, stage, table

# Packing cannot be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def _sized(docs: DataFrame) -> DataFrame:
    """The size column again, after the text has changed."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, table(ready(spark), sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that came before, in nearly the same words."""
    ready(spark)
    return _sized(fuzzy_lines.deduplicated(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ready(spark)
    return near_dup.representatives(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their secrets replaced."""
    ready(spark)
    return _sized(secret_scan.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
