"""Cut scores into marketing segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN, SEGMENT_LABELS


def segment_of(score: Column, t1: float, t2: float) -> Column:
    """[0, t1], (t1, t2] and (t2, 1]; NULL outside, for NaN and for a missing score."""
    if not 0 < t1 < t2 < 1:
        raise ValueError("thresholds must increase strictly: 0 < t1 < t2 < 1")
    low, middle, high = SEGMENT_LABELS
    return (
        F.when(F.isnan(score) | (score < 0) | (score > 1), F.lit(None))
        .when(score <= t1, low)
        .when(score <= t2, middle)
        .when(score <= 1, high)
    )


def bucketize(df: DataFrame, t1: float = 0.2, t2: float = 0.5) -> DataFrame:
    """Add the segment of every score."""
    absent = [c for c in (ID_COLUMN, "score") if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")
    return df.withColumn("segment", segment_of(F.col("score").cast("double"), t1, t2))


def distribution(df: DataFrame) -> DataFrame:
    """Rows and share per segment, largest first; empty segments show 0.

    Rows without a segment form their own group, if there are any, and count in the shares.
    """
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("segment").isNull()).alias("none"),
        *(F.count_if(F.col("segment") == label).alias(label) for label in SEGMENT_LABELS),
    )
    rows = [(F.lit(label), F.col(label)) for label in SEGMENT_LABELS]
    rows.append((F.lit(None).cast("string"), F.col("none")))
    long = totals.select(
        "n",
        F.inline(F.array(*(F.struct(s.alias("segment"), c.alias("row_count")) for s, c in rows))),
    ).filter(F.col("segment").isNotNull() | (F.col("row_count") > 0))
    share = F.col("row_count") / F.nullif(F.col("n"), F.lit(0))
    return long.select("segment", "row_count", share.alias("share")).orderBy(
        F.desc("row_count"), F.asc_nulls_last("segment")
    )
