"""Exact ROC-AUC and tree feature importance."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promolens.functions.expr import quoted
from promolens.session import stage

SCORE_RANGES = 512


def _score_ranges(counts: DataFrame) -> list[float]:
    """Bounds that cut the distinct scores into about equal parts."""
    probabilities = [i / SCORE_RANGES for i in range(1, SCORE_RANGES)]
    inner = counts.approxQuantile("score", probabilities, 1 / (4 * SCORE_RANGES))
    finite = sorted({x for x in inner if abs(x) != float("inf")}) or [0.0]
    return [float("-inf"), *finite, float("inf")]


def roc_auc(
    df: DataFrame, score: str = "score", label: str = "label", by: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half. NULL if a class is missing.

    With ``by``, one row for each of its values, all in one pass. Rows are first folded to one row
    per distinct score. The running count over scores is computed inside score ranges and shifted
    by the totals of the ranges below (at most ``SCORE_RANGES`` rows each), so no task sees all
    scores. The folded rows are stored once, so an expensive score is computed once. Rows without
    score or label are not counted.
    """
    group = F.lit(0) if by is None else quoted(by)
    rows = df.select(
        group.alias("grp"),
        quoted(score).cast("double").alias("score"),
        quoted(label).cast("int").alias("label"),
    ).filter(F.col("score").isNotNull() & F.col("label").isNotNull())
    counts = rows.groupBy("grp", "score").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")
    )
    counts = stage(counts, "score-counts")
    bounds = _score_ranges(counts)
    ranged = Bucketizer(splits=bounds, inputCol="score", outputCol="part").transform(counts)

    totals = ranged.groupBy("grp", "part").agg(F.sum("neg").alias("part_neg"))
    before = W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "grp", "part", F.coalesce(F.sum("part_neg").over(before), F.lit(0)).alias("neg_before")
    )
    below = W.partitionBy("grp", "part").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0))
    beaten = 2 * (F.col("neg_before") + F.col("neg_in_part")) + F.col("neg")
    wins = F.col("pos").cast("decimal(19,0)") * beaten.cast("decimal(19,0)")
    sums = (
        F.sum(wins).alias("half_wins"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    joined = ranged.withColumn("neg_in_part", neg_below).join(offsets, ["grp", "part"])
    summed = joined.agg(*sums) if by is None else joined.groupBy("grp").agg(*sums)
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    area = F.col("half_wins").cast("double") / F.nullif(2 * pairs, F.lit(0.0))
    named = [] if by is None else [F.col("grp").alias(by)]
    return summed.select(*named, area.alias("auc"), "positives", "negatives")


def feature_importance(
    spark: SparkSession, model_path: str, names: tuple[str, ...] | list[str]
) -> DataFrame:
    """Total gain and split count per feature from a saved boosted-tree model.

    Reads the node table MLlib saves with the model; features never split on show 0.
    """
    nodes = spark.read.parquet(f"{model_path}/data").select("nodeData.*")
    splits = nodes.filter(F.col("leftChild") >= 0)
    used = splits.groupBy(F.col("split.featureIndex").alias("position")).agg(
        F.sum(F.col("gain") * F.col("rawCount")).alias("importance_gain"),
        F.count(F.lit(1)).alias("importance_split"),
    )
    listed = spark.createDataFrame(
        list(enumerate(names)), "position int, feature string"
    )
    return (
        listed.join(used, "position", "left")
        .select(
            "feature",
            F.coalesce("importance_gain", F.lit(0.0)).alias("importance_gain"),
            F.coalesce("importance_split", F.lit(0)).alias("importance_split"),
        )
        .orderBy(F.desc("importance_gain"), "feature")
    )
