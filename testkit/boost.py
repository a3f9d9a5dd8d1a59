"""Queries of the leaf-wise booster over the prepared rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN, TARGET_COLUMN, LeafwiseConfig, RunConfig
from promolens.functions.expr import quoted
from promolens.operators import binning, boosting, split, training
from promolens.operators.prepare import PrepMetadata
from promolens.operators.trees import BoostedTrees
from promolens.session import stage, staging_path
from promolens.sources import artifacts
from testkit.boost_sql import ROUND
from testkit.oracle import NUMERIC_FEATURES, SEED

# Production settings but for the rounds: a round costs some seconds of job starts at any size.
SHORT = replace(LeafwiseConfig(), rounds=6, block=3)


def rows_of(prepared: DataFrame) -> DataFrame:
    """The prepared rows, stored as a run does, with their side of the split."""
    rows = stage(prepared, "boosting-prepared")
    placed = split.stratified(rows, fraction=0.2, seed=SEED).select(
        ID_COLUMN, quoted(TARGET_COLUMN).cast("int").alias("label"), "is_validation",
        *NUMERIC_FEATURES,
    )
    return stage(placed, "boosting-placed")


def _bins(rows: DataFrame) -> binning.Bins:
    return binning.fit_bins(rows.where("is_validation = 0"), NUMERIC_FEATURES, ROUND.max_bins)


def bins(rows: DataFrame) -> DataFrame:
    found = _bins(rows)
    listed = [(n, c) for n, cuts in zip(found.names, found.cuts, strict=True) for c in cuts]
    return rows.sparkSession.createDataFrame(listed, "feature string, cut double")


def _drawn(rows: DataFrame):
    of_round = boosting.is_drawn(F.col(ID_COLUMN), SEED, 1, ROUND.row_fraction)
    return (F.col("is_validation") == 0) & of_round


def draws(rows: DataFrame) -> DataFrame:
    return rows.select(ID_COLUMN, "is_validation", _drawn(rows).alias("drawn"))


def gradient_sums(rows: DataFrame) -> DataFrame:
    """The root's histogram of round one, over the features of its tree."""
    cuts = _bins(rows)
    used = boosting.drawn_features(SEED, 1, NUMERIC_FEATURES, ROUND.feature_fraction)
    ones = rows.where("is_validation = 0").agg(F.avg("label")).first()[0]
    base = F.log(F.lit(ones) / (1 - F.lit(ones)))
    g, h = boosting.gradients(base, F.col("label"))
    keep = [F.col("label"), g.alias("g"), h.alias("h")]
    cells = binning.binned(rows.where(_drawn(rows)), cuts, keep).select(
        "g", "h", F.inline(F.array(*(
            F.struct(F.lit(i).alias("f"), F.col("x")[i].cast("long").alias("bin")) for i in used
        )))
    )
    return cells.groupBy("f", "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n")
    )


def first_round(rows: DataFrame) -> DataFrame:
    """Log-odds and leaf of every row after one round."""
    fitted = boosting.fit(rows, NUMERIC_FEATURES, ROUND, SEED, ID_COLUMN)
    (tree,) = fitted.model.trees
    values = F.array(*(quoted(n).cast("double") for n in NUMERIC_FEATURES))
    sizes = F.array(*map(F.lit, tree.rows))
    found = fitted.model.margins(rows).withColumn("_x", values)
    return found.select(
        ID_COLUMN, F.round("margin", 9).alias("margin"),
        sizes[tree.node("_x")].cast("long").alias("leaf_rows"),
    )


def round_model(prepared: DataFrame, meta: PrepMetadata) -> str:
    """The folder of a model that a whole training run of one round saved."""
    spark = prepared.sparkSession
    rows = stage(
        prepared.select(ID_COLUMN, quoted(TARGET_COLUMN), *NUMERIC_FEATURES), "boosting-run"
    )
    cfg = RunConfig(test_size=0.2, seed=SEED, boosting=ROUND)
    result = training.train(rows, NUMERIC_FEATURES, cfg)
    folder = staging_path(spark, "round-model")
    meta = replace(meta, feature_columns=tuple(NUMERIC_FEATURES))
    artifacts.save_run(spark, result.model, meta, result.metrics, folder)
    return folder


def rounds(rows: DataFrame) -> DataFrame:
    """The held-out AUC after each round."""
    fitted = boosting.fit(rows, NUMERIC_FEATURES, SHORT, SEED, ID_COLUMN)
    listed = [(i, a) for i, a in enumerate(fitted.areas, 1)]
    return rows.sparkSession.createDataFrame(listed, "round int, auc double")


def expressions_agree(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Whether the looked-up trees and their SQL text score every customer alike."""
    model = boosting.fit(rows, NUMERIC_FEATURES, SHORT, SEED, ID_COLUMN).model
    back = BoostedTrees.from_text(model.to_text())
    scored = back.probabilities(whole, "looked_up")
    return scored.select(
        ID_COLUMN, (F.abs(F.expr(model.sql()) - F.col("looked_up")) < 1e-12).alias("same")
    )
