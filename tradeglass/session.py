"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on; all can be set on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings and make sure a checkpoint folder is known."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    scratch_dir(spark)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names.  Only a local session, whose tasks share the
    driver's disk, may do with a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tradeglass-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def together(*steps: Callable[[], object]) -> None:
    """Run independent steps at the same time, so that small jobs do not wait for each other.  Raises the
    first error, after all have ended."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = [pool.submit(copy_context().run, step) for step in steps]
    for step in running:
        step.result()


# Intermediate tables to delete at the end of the job that runs here.
_intermediate: ContextVar[list[str] | None] = ContextVar("intermediate", default=None)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write a result that several later steps read to the shared scratch folder, and read it back: it is
    computed once, and outlives the executors.  Within ``releasing`` it is deleted at the end."""
    path = f"{scratch_dir(df.sparkSession).rstrip('/')}/intermediate/{uuid.uuid4().hex}"
    df.write.parquet(path)
    kept = _intermediate.get()
    if kept is not None:
        kept.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables of a job once it has written its results.  Of nested jobs the outer
    one deletes."""
    if _intermediate.get() is not None:
        yield
        return
    kept: list[str] = []
    token = _intermediate.set(kept)
    try:
        yield
    finally:
        _intermediate.reset(token)
        for name in kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
