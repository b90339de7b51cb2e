"""Buckets by hash."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bucket_of(buckets: int, *keys: Column) -> Column:
    """The bucket of a key; of literals it is a literal, so a filter by it prunes folders."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
