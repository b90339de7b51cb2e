"""Exact deduplication with a persistent digest index, bucketed and sorted by digest.

The index is a table on shared storage.  A batch is first reduced to one row per digest, by partial
aggregation, so a group of copies of any size costs one row per map task.  A sort-merge anti-join with
the index then finds the digests that are new; the index side is read bucket by bucket and is never
shuffled.  The new rows are appended.

Cases: a null text counts as empty; empty texts are equal to each other.  Of equal texts in one batch the
largest id stays (a null id only if there is no other).  A text that the index holds from an earlier batch
stays with the id it has there.  Rows that repeat an id together with its text are one document, and
share its decision; ``survivors`` returns it once.  Columns other than id and text are not read.  An
empty table gives an empty result and adds nothing.  A batch that is added again after a failure adds only
what is missing, and gets the same decisions.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeglass.llm.common import stage, text_or_empty


class DigestIndex:
    """The digests seen so far, with the id that stays for each."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """``path`` lies on storage that all executors share.  ``buckets`` is fixed when the index is
        made: as many as the shuffle partitions, unless given; choose it so that a bucket fits a task."""
        self.spark, self.path = spark, path
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"digest_index_{hashlib.sha256(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate a batch in itself and against the index, append what is new, and return per row
        doc_id, keep_id, group_size (rows of the batch with that text), kept, text_sha256."""
        rows = stage(
            batch.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text_or_empty(text_col), 256)).alias("digest")),
            "digests",
        )
        groups = stage(
            rows.groupBy("digest").agg(F.max("doc_id").alias("own_id"), F.count(F.lit(1)).alias("group_size")),
            "digest-groups",
        )
        fresh = groups.join(self.rows().hint("merge"), "digest", "left_anti")
        (
            fresh.select("digest", F.col("own_id").alias("keep_id"))
            .write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )
        kept = stage(
            groups.join(self.rows().hint("merge"), "digest").select("digest", "keep_id", "group_size"), "digest-kept"
        )
        # A digest may have a third of the rows: both sides are shuffled, so Spark splits such a partition.
        return rows.join(kept, "digest").select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def survivors(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The documents of a batch that stay, with all their columns."""
        kept = self.add(batch, id_col, text_col).filter("kept").select("doc_id", "text_sha256").distinct()
        same = [
            batch[id_col].eqNullSafe(kept["doc_id"]),
            F.sha2(F.coalesce(batch[text_col], F.lit("")), 256) == kept["text_sha256"],
        ]
        return batch.dropDuplicates([id_col, text_col]).join(kept, same, "left_semi")
