"""Whole runs: prepare, train, score and segment; with a saved model; or on after a break."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from promolens.config import RunConfig
from promolens.operators import prepare, scoring, segments, training
from promolens.operators.customers import feature_table
from promolens.operators.metrics import feature_importance
from promolens.operators.trees import BoostedTrees
from promolens.plans.manifest import Manifest, fingerprint, table_fingerprint
from promolens.session import many_parts, remove_staged, stage, tune
from promolens.sources import artifacts, sinks
from promolens.sources.tables import SourceTables


@dataclass(frozen=True)
class RunResult:
    metadata: prepare.PrepMetadata
    metrics: dict
    importance: DataFrame
    segments: DataFrame


def build_features(tables: SourceTables, as_of: date) -> DataFrame:
    """The feature table, written once to the staging folder."""
    tune(tables.orders.sparkSession)
    with many_parts(tables.orders.sparkSession):
        return stage(feature_table(tables, as_of), "features")


def fit_model(
    spark: SparkSession, features: DataFrame, model_dir: str, cfg: RunConfig = RunConfig()
) -> tuple[prepare.PrepMetadata, dict]:
    """Prepare and train; the model folder gets trees, metadata and metrics.

    Leaf-wise training that was broken goes on from its last stored rounds.
    """
    tune(spark)
    meta = prepare.fit(features, cfg)
    frame = stage(prepare.training_frame(features, meta), "prepared")
    try:
        result = training.train(
            frame, meta.feature_columns, cfg, folder=f"{model_dir}/progress"
        )
    finally:
        remove_staged(spark, frame)
    artifacts.save_run(spark, result.model, meta, result.metrics, model_dir)
    return meta, result.metrics


def importance_of(spark: SparkSession, model_dir: str) -> DataFrame:
    meta = artifacts.load_metadata(spark, model_dir)
    model = artifacts.load_model(spark, model_dir)
    if isinstance(model, BoostedTrees):
        return model.importance(spark)
    return feature_importance(spark, artifacts.trees_path(spark, model_dir), meta.feature_columns)


def score_only(
    spark: SparkSession, features: DataFrame, model_dir: str, cfg: RunConfig = RunConfig()
) -> DataFrame:
    """Score and segment with a saved model and the metadata saved beside it."""
    meta = artifacts.load_metadata(spark, model_dir)
    model = artifacts.load_model(spark, model_dir)
    return segments.bucketize(scoring.score(features, model, meta), cfg.t1, cfg.t2)


def run(
    spark: SparkSession,
    features: DataFrame,
    model_dir: str,
    cfg: RunConfig = RunConfig(),
    output_dir: str | None = None,
) -> RunResult:
    """The full run over a stored feature table. Any failing step ends it."""
    meta, metrics = fit_model(spark, features, model_dir, cfg)
    importance = importance_of(spark, model_dir)
    # Written once, so that a later use does not score all customers again.
    segmented = stage(score_only(spark, features, model_dir, cfg), "segments")
    if output_dir is not None:
        sinks.write_csv(importance, f"{output_dir}/feature_importance")
        sinks.write_csv(segmented.drop("segment"), f"{output_dir}/scores")
        sinks.write_csv(segmented, f"{output_dir}/scores_bucketized")
    return RunResult(meta, metrics, importance, segmented)


def run_resumable(
    spark: SparkSession,
    features: DataFrame,
    run_dir: str,
    cfg: RunConfig = RunConfig(),
    skip_training: bool = False,
    model_dir: str | None = None,
) -> tuple[RunResult, Manifest]:
    """The full run in steps whose finished results a later call reuses.

    Each step is fingerprinted by what it reads: training by the rows and the settings other than
    the thresholds, scores by the rows and the model, segments by scores and thresholds. So a run
    that broke after training goes on without a second fit, new thresholds only cut the scores
    again, and changed rows do everything anew. Outputs are published together, at the end, with
    the folder of each in one record; until then the ones of an earlier run stay in use.

    ``skip_training`` scores with the model in ``model_dir``, whose metadata name it.
    """
    tune(spark)
    if skip_training and model_dir is None:
        raise ValueError("skip_training needs the model_dir of a saved model")
    steps = Manifest(spark, run_dir)
    rows = table_fingerprint(features)
    settings = {k: v for k, v in asdict(cfg).items() if k not in ("t1", "t2")}
    settings["boosting"] = [type(cfg.boosting).__name__, settings["boosting"]]
    if not skip_training:
        learned = fingerprint("train", rows, settings)
        model_dir = steps.step("train", learned, lambda path: fit_model(spark, features, path, cfg))
    version = fingerprint(artifacts.trees_path(spark, model_dir))
    importance_dir = steps.step(
        "importance",
        fingerprint("importance", version),
        lambda path: sinks.write_csv(importance_of(spark, model_dir), path),
    )

    def write_scores(path: str) -> None:
        meta = artifacts.load_metadata(spark, model_dir)
        model = artifacts.load_model(spark, model_dir)
        sinks.write_prepared(scoring.score(features, model, meta), path)

    scored = fingerprint("scores", rows, version)
    score_dir = steps.step("scores", scored, write_scores)
    scores = spark.read.parquet(score_dir)
    csv_dir = steps.step("scores_csv", scored, lambda path: sinks.write_csv(scores, path))
    cut = fingerprint("segments", scored, cfg.t1, cfg.t2)
    segment_dir = steps.step(
        "segments",
        cut,
        lambda path: sinks.write_prepared(segments.bucketize(scores, cfg.t1, cfg.t2), path),
    )
    segmented = spark.read.parquet(segment_dir)
    segment_csv = steps.step("segments_csv", cut, lambda path: sinks.write_csv(segmented, path))
    steps.publish(
        {
            "model": model_dir,
            "feature_importance": importance_dir,
            "scores": csv_dir,
            "scores_bucketized": segment_csv,
        }
    )
    result = RunResult(
        artifacts.load_metadata(spark, model_dir),
        artifacts.load_metrics(spark, model_dir),
        importance_of(spark, model_dir),
        segmented,
    )
    return result, steps
