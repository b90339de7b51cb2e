"""What the operators of this package share: session settings, staged tables and literal lookups."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

import tradeglass
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeglass.session import prepare, scratch_dir

# Texts go to Python in Arrow batches; both limits keep a batch of long texts small.
BATCH_ROWS = "512"
BATCH_BYTES = str(8 << 20)
_ARCHIVE = "tradeglass_package"


def ready(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators rely on, and send this package to the Python workers."""
    prepare(spark)
    context = spark.sparkContext
    if not any(f.startswith(_ARCHIVE) for f in context._python_includes):
        root = os.path.dirname(os.path.dirname(os.path.abspath(tradeglass.__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="tradeglass-"), _ARCHIVE)
        context.addPyFile(shutil.make_archive(archive, "zip", root, os.path.basename(os.path.dirname(tradeglass.__file__))))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared scratch folder."""
    return f"{scratch_dir(spark)}/stages/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.  This cuts the lineage: the files
    lie in the shared folder, so a lost executor costs only its running tasks."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def stage_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """``stage``, with a file for each shuffle partition by the key: this table is then joined and grouped by the key
    without a shuffle of its own rows.  ``unstage`` also drops its name from the session's catalog."""
    spark, path = df.sparkSession, stage_path(df.sparkSession, name)
    known = f"staged_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(parts, key).sortBy(key).option("path", path).saveAsTable(known)
    staged = spark.table(known)
    staged.staged_at, staged.staged_as = path, known
    return staged


def unstage(*staged: DataFrame) -> None:
    """Delete staged tables that no later step reads, itself or through a plan."""
    for df in staged:
        if hasattr(df, "staged_as"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.staged_as}")
        _delete(df.sparkSession, df.staged_at)


def drop_stages(spark: SparkSession) -> None:
    """Delete the staged tables, once the results built on them are written."""
    _delete(spark, f"{scratch_dir(spark)}/stages")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def longs(values: list[int]) -> Column:
    """An array literal for a lookup table of bounded size."""
    return F.lit([int(v) for v in values]).cast("array<bigint>") if values else F.array().cast("array<bigint>")


def unit_hash(column: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed alone."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
