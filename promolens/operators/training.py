"""Boosted-tree training with the number of rounds chosen on held-out rows."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark import SparkContext
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN, TARGET_COLUMN, LeafwiseConfig, RunConfig
from promolens.functions.expr import sql_columns, ident, quoted
from promolens.operators import boosting
from promolens.operators.metrics import roc_auc
from promolens.operators.split import balance, stratified
from promolens.operators.trees import BoostedTrees


@dataclass(frozen=True)
class TrainingResult:
    model: GBTClassificationModel | BoostedTrees
    metrics: dict


def feature_names(df: DataFrame, names=None, label: str = TARGET_COLUMN) -> list[str]:
    """The recorded feature list, else every column but the target."""
    if label not in df.columns:
        raise ValueError(f"target column {label} not found")
    chosen = [c for c in df.columns if c != label] if names is None else list(names)
    absent = [c for c in chosen if c not in df.columns]
    if absent:
        raise ValueError(f"feature columns not found: {absent}")
    return chosen


def assemble(df: DataFrame, names, keep: list[Column]) -> DataFrame:
    """One vector column next to ``keep``; feature names may hold any character."""
    slots = [f"f{i}" for i in range(len(names))]
    flat = df.select(
        *keep, *sql_columns(*(f"CAST({ident(n)} AS DOUBLE) AS {s}" for n, s in zip(names, slots)))
    )
    vector = VectorAssembler(inputCols=slots, outputCol="features", handleInvalid="error")
    return vector.transform(flat).drop(*slots)


def probability() -> Column:
    """Probability of the positive class from a scored row."""
    return vector_to_array(F.col("probability"))[1]


def best_round(areas: list[float | None], patience: int) -> int:
    """Rounds to keep: the highest held-out AUC before ``patience`` rounds without a gain."""
    best = 0
    for i, area in enumerate(areas):
        if (area or 0.0) > (areas[best] or 0.0):
            best = i
        elif i - best >= patience:
            break
    return best + 1


def round_scores(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    """(round, score, label): the margin of every row after each round, one tree at a time."""
    kept = rows.select("label", "features")
    names = [f"tree{i}" for i in range(model.getNumTrees)]
    for name, tree in zip(names, model.trees, strict=True):
        kept = tree.setPredictionCol(name).transform(kept)
    weights = zip(names, model.treeWeights, strict=True)
    weighted = [f"{name} * {weight}D" for name, weight in weights]
    margins = F.expr(
        f"transform(sequence(1, {len(names)}), k -> struct(k AS round,"
        f" aggregate(slice(array({', '.join(weighted)}), 1, k), 0D, (s, x) -> s + x) AS score))"
    )
    return kept.select("label", F.inline(margins))


def first_trees(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model as it was after so many rounds."""
    java = model._java_obj
    gateway = SparkContext._active_spark_context._gateway
    jvm = gateway.jvm
    trees = gateway.new_array(
        jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds
    )
    weights = gateway.new_array(jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = java.trees()[i], java.treeWeights()[i]
    shorter = jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses()
    )
    return GBTClassificationModel(java.copyValues(shorter, java.extractParamMap()))


def train(
    df: DataFrame,
    names=None,
    cfg: RunConfig = RunConfig(),
    key: str | None = ID_COLUMN,
    folder: str | None = None,
) -> TrainingResult:
    """Split, boost, keep the best number of rounds on the held-out side, and measure it.

    With a ``LeafwiseConfig`` the trees grow leaf by leaf and stop by the AUC while they are
    trained, and ``folder`` holds what a broken run goes on from. Otherwise the model is fitted once. One pass over the held-out rows yields the AUC after every round,
    and the trees up to the best round are kept. The held-out side chooses the rounds and yields
    the AUC, so that figure is optimistic. Give it a stored frame: boosting passes over the data
    many times.
    """
    key = key if key in df.columns else None
    names = feature_names(df.drop(key) if key else df, names)
    split = stratified(
        df, key=key, fraction=cfg.test_size, seed=cfg.seed, mode=cfg.split_mode
    )
    sides = {r["is_validation"]: r for r in balance(split).collect()}
    if set(sides) != {0, 1}:
        raise ValueError("the split leaves one side empty; change test_size or seed")
    if isinstance(cfg.boosting, LeafwiseConfig):
        unit = quoted(key) if key else F.xxhash64(*(quoted(c) for c in df.columns))
        rows = split.select(unit.alias("_unit"), quoted(TARGET_COLUMN), "is_validation",
                            *(quoted(n) for n in names))
        fitted = boosting.fit(
            rows, names, cfg.boosting, cfg.seed, "_unit", TARGET_COLUMN, folder=folder
        )
        area = fitted.areas[fitted.best_round - 1]
        return TrainingResult(
            fitted.model, _metrics(area, fitted.best_round, sides, names, cfg)
        )
    data = assemble(
        split, names, [quoted(TARGET_COLUMN).cast("double").alias("label"), F.col("is_validation")]
    )
    fitted, held_out = (data.filter(F.col("is_validation") == side) for side in (0, 1))
    boost = cfg.boosting
    booster = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        lossType="logistic",
        maxIter=boost.max_iter,
        stepSize=boost.step_size,
        maxDepth=boost.max_depth,
        maxBins=boost.max_bins,
        minInstancesPerNode=boost.min_instances_per_node,
        featureSubsetStrategy=str(boost.feature_fraction),
        subsamplingRate=boost.subsampling_rate,
        seed=cfg.seed,
    )
    model = booster.fit(fitted)
    by_round = roc_auc(round_scores(model, held_out), by="round").collect()
    areas = {r["round"]: r["auc"] for r in by_round}
    areas = [areas.get(i + 1) for i in range(model.getNumTrees)]
    rounds = best_round(areas, boost.early_stopping_rounds)
    model = first_trees(model, rounds)
    area = areas[rounds - 1]
    return TrainingResult(model, _metrics(area, model.getNumTrees, sides, names, cfg))


def _metrics(area: float | None, rounds: int, sides: dict, names, cfg: RunConfig) -> dict:
    return {
        "validation_auc": area,
        "best_iteration": rounds,
        "n_train": sides[0]["row_count"],
        "n_val": sides[1]["row_count"],
        "pos_rate_train": sides[0]["positive_rate"],
        "pos_rate_val": sides[1]["positive_rate"],
        "params": {**asdict(cfg.boosting), "seed": cfg.seed},
        "feature_count": len(names),
    }
