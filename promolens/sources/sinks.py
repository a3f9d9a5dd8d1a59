"""Writers for the feature table, prepared frames and result files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN


def write_feature_table(df: DataFrame, path: str, key: str = ID_COLUMN) -> None:
    """Parquet, each file sorted by customer.

    The feature job ends in a grouping by customer, so its partitions already keep a
    customer together; sorting inside them needs no shuffle.
    """
    df.sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def save_feature_table(
    df: DataFrame, table: str, buckets: int, key: str = ID_COLUMN, path: str | None = None
) -> None:
    """Catalog table bucketed and sorted by customer: later joins on it need no shuffle."""
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_prepared(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header; NULL becomes an empty field."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json_record(spark: SparkSession, record: dict, path: str) -> None:
    """One small JSON object on any file system Spark can reach."""
    line = spark.range(1).select(F.lit(json.dumps(record, sort_keys=True)).alias("value"))
    line.coalesce(1).write.mode("overwrite").text(path)


def read_json_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])
