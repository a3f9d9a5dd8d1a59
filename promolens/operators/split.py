"""Stratified train/validation split by a hash of the customer key."""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN, TARGET_COLUMN
from promolens.functions.expr import key_hash, quoted

HASH_BITS = 60
BUCKET_BITS = 16
MAX_CLASSES = 100


def holdout_sizes(class_rows: dict, fraction: float) -> dict:
    """Validation rows per class: the rounded-up total, shared out by largest remainder."""
    total = sum(class_rows.values())
    wanted = math.ceil(fraction * total)
    exact = {label: wanted * n / total for label, n in class_rows.items()}
    sizes = {label: math.floor(x) for label, x in exact.items()}
    by_remainder = sorted(exact, key=lambda c: (sizes[c] - exact[c], c))
    for label in by_remainder[: wanted - sum(sizes.values())]:
        sizes[label] += 1
    return sizes


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _cut_points(hashed: DataFrame, fraction: float) -> dict:
    """Per class, the largest hash that still belongs to the holdout.

    A histogram of 2**16 hash ranges finds the range holding the cut; only the keys of that
    range are counted one by one. Both steps combine on the map side, so copies of one key
    are one row before anything is ranked.
    """
    label = F.col("label")
    bucket = F.shiftright("h", HASH_BITS - BUCKET_BITS)
    histogram = hashed.groupBy("label", bucket.alias("bucket")).agg(F.expr("count(1) AS n"))
    running = F.sum("n").over(W.partitionBy("label").orderBy("bucket"))
    ranges = histogram.select("label", "bucket", "n", running.alias("upto")).persist()
    try:
        # Two classes are wanted; a label with many values is a mistake that must not be collected.
        class_rows = dict(ranges.groupBy("label").agg(F.sum("n")).limit(MAX_CLASSES + 1).collect())
        if len(class_rows) > MAX_CLASSES:
            raise ValueError(f"the label has more than {MAX_CLASSES} values")
        if not class_rows:
            return {}
        sizes = holdout_sizes(class_rows, fraction)
        beyond = _any([(label == c) & (F.col("upto") > size) for c, size in sizes.items()])
        firsts = ranges.filter(beyond).groupBy("label").agg(
            F.expr("min(struct(bucket, n, upto)) AS first")
        )
        cut_range = {r["label"]: r["first"] for r in firsts.collect()}
    finally:
        ranges.unpersist()

    left = {c: sizes[c] - (r["upto"] - r["n"]) for c, r in cut_range.items()}
    inside = _any([(label == c) & (bucket == r["bucket"]) for c, r in cut_range.items()])
    keys = hashed.filter(inside).groupBy("label", "h").agg(F.expr("count(1) AS n"))
    ranked = keys.withColumn("upto", F.sum("n").over(W.partitionBy("label").orderBy("h")))
    fits = _any([(label == c) & (F.col("upto") <= n) for c, n in left.items()])
    last = dict(ranked.filter(fits).groupBy("label").agg(F.max("h")).collect())

    def cut(c) -> int:
        if c not in cut_range:  # the whole class is held out
            return (1 << HASH_BITS) - 1
        return last.get(c, (cut_range[c]["bucket"] << (HASH_BITS - BUCKET_BITS)) - 1)

    return {c: cut(c) for c in sizes}


def stratified(
    df: DataFrame,
    label: str = TARGET_COLUMN,
    key: str | None = ID_COLUMN,
    fraction: float = 0.2,
    seed: int = 42,
    mode: str = "exact",
) -> DataFrame:
    """Add ``is_validation`` (0/1) without moving a row.

    ``approx`` takes every key whose hash falls below the fraction. ``exact`` also matches
    the size per class: the hash cut is searched in two small counting jobs and then applied
    row by row. Rows that share a key always land on the same side. The whole row takes the
    place of a missing key, or of every key without a key column. A row without a label belongs
    to no class, so it fails when it is read.
    """
    whole = F.to_json(F.struct(*(quoted(c) for c in df.columns)))
    unit = whole if key is None else F.coalesce(quoted(key).cast("string"), whole)
    problem = F.raise_error(F.lit(f"column {label}: a row has no label"))
    kind = df.schema[label].dataType
    df = df.withColumn(label, F.coalesce(quoted(label), problem.cast(kind)))
    h = key_hash(unit, seed)
    if mode == "approx":
        cut: Column = F.lit(math.floor(fraction * (1 << HASH_BITS)))
        chosen = h < cut
    elif mode == "exact":
        cuts = _cut_points(df.select(quoted(label).alias("label"), h.alias("h")), fraction)
        chosen = _any([(quoted(label) == c) & (h <= last) for c, last in cuts.items()])
    else:
        raise ValueError(f"unknown split mode: {mode}")
    return df.withColumn("is_validation", chosen.cast("int"))


def balance(split: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """Rows and positive rate on each side of the split."""
    return split.groupBy("is_validation").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(quoted(label).cast("bigint")).alias("positives"),
        F.avg(quoted(label)).alias("positive_rate"),
    )
