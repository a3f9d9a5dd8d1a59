"""Session settings and the shared staging folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs are written for. A join whose key turns out hot at run
# time is split even when the split costs one more (pre-aggregated) shuffle after it.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A task of the feature job holds some fifteen times what it reads, so it is given little.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

# Parts that a shuffle of the feature job can be cut into, whatever the session's default; small
# ones are put together again at run time. With more than 200, Spark's map tasks sort their output
# by part and hold it in memory (``spark.shuffle.sort.bypassMergeThreshold``).
SHUFFLE_PARTS = 200

# For sessions created for these jobs: the feature job generates more classes than the default
# cache holds, and without room for them every run compiles them again.
SESSION_SETTINGS = {"spark.sql.codegen.cache.maxEntries": "1000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def many_parts(spark: SparkSession) -> Iterator[None]:
    """Shuffles planned and run inside have at least ``SHUFFLE_PARTS`` parts to be put together."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    default = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(name, str(max(SHUFFLE_PARTS, int(before or default))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@cache
def _local_staging() -> str:
    return tempfile.mkdtemp(prefix="promolens-")


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A session that names none fails, because executors and driver would each write to disks of
    their own. Only where all of them are one process (master ``local``) is there a folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_staging()


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_root(spark)}/promolens/{name}-{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files behind a DataFrame that ``stage`` returned and that nobody needs now."""
    root = f"{staging_root(spark)}/promolens/"
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if root.removeprefix("file:").lstrip("/") in folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of DataFrames that nothing refers to any more.

    Its cleaner works when the driver collects garbage, which in a long job with a roomy driver
    may be half an hour apart. Safe where all that is needed later lies in staged tables.
    """
    gc.collect()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a shared parquet table and read it back.

    Cuts the lineage, survives executor loss, and keeps column pruning and filter
    pushdown for every later read.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
