import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from promolens.config import BoostConfig, RunConfig, preset
from promolens.operators import metrics, segments, split, training
from promolens.plans import runs
from promolens.sources import artifacts


def scored(spark, pairs):
    return spark.createDataFrame([(float(s), y) for s, y in pairs], "score double, label int")


@pytest.mark.parametrize("pairs, area", [
    ([(0.5, 0), (0.5, 1), (0.5, 1), (0.5, 0)], 0.5),
    ([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], 1.0),
    ([(0.9, 0), (0.8, 0), (0.1, 1)], 0.0),
    ([(0.1, 0), (0.5, 1), (0.5, 0), (0.7, 1)], 0.875),
    ([(0.1, 1), (0.5, 1)], None),
])
def test_auc_small_cases(spark, pairs, area):
    assert metrics.roc_auc(scored(spark, pairs)).first().auc == area


def test_auc_agrees_with_mllib_over_many_ranges_and_a_hot_score(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.rand(7)).alias("score"), F.col("id"))
    df = df.select("score", (F.rand(8) < 0.2 + 0.5 * F.col("score")).cast("int").alias("label"))
    df = spark.createDataFrame(df.toPandas())
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    expected = evaluator.evaluate(df.withColumn("label", F.col("label").cast("double")))
    assert metrics.roc_auc(df).first().auc == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("rows, fraction", [(1000, 0.2), (997, 0.33), (10, 0.5)])
def test_exact_split_sizes(spark, rows, fraction):
    df = spark.range(rows).selectExpr(
        "id as externalcustomerkey", "cast(id % 7 = 0 as int) as y_discount_sensitive")
    out = split.stratified(df, fraction=fraction, seed=1)
    held = {r.y_discount_sensitive: r.n for r in out.filter("is_validation = 1").groupBy(
        "y_discount_sensitive").agg(F.count("*").alias("n")).collect()}
    ones = math.ceil(rows / 7)
    assert sum(held.values()) == math.ceil(fraction * rows)
    assert abs(held[1] - fraction * ones) <= 1
    other = split.stratified(df, fraction=fraction, seed=2).filter("is_validation = 1")
    assert rows <= 10 or other.exceptAll(out.filter("is_validation = 1")).count() > 0


def test_split_keeps_copies_together_even_when_one_key_is_hot(spark):
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, id) as externalcustomerkey", "0 as y_discount_sensitive")
    for mode in ("exact", "approx"):
        out = split.stratified(df, fraction=0.2, mode=mode)
        sides = out.groupBy("externalcustomerkey").agg(F.countDistinct("is_validation").alias("n"))
        assert sides.agg(F.max("n")).first()[0] == 1
        assert out.count() == 3000


def test_holdout_sizes_share_out_the_rounded_total():
    assert split.holdout_sizes({0: 4, 1: 6}, 0.2) == {0: 1, 1: 1}
    assert split.holdout_sizes({0: 3, 1: 3}, 0.5) == {0: 2, 1: 1}
    assert sum(split.holdout_sizes({0: 5_000_000, 1: 823_241}, 0.2).values()) == 1_164_649


def test_segment_borders(spark):
    values = [-0.0005, 0.0, 0.2, 0.2000001, 0.5, 1.0, 1.01, None, float("nan")]
    df = spark.createDataFrame(list(enumerate(values)), "externalcustomerkey int, score double")
    found = [r.segment for r in segments.bucketize(df).orderBy("externalcustomerkey").collect()]
    assert found == [None, "full_price", "full_price", "conditional", "conditional",
                     "discount_driven", None, None, None]


def test_distribution_lists_empty_segments_and_counts_missing(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.1), (3, 0.9), (4, None)],
                               "externalcustomerkey int, score double")
    found = [tuple(r) for r in segments.distribution(segments.bucketize(df)).collect()]
    assert found == [("full_price", 2, 0.5), ("discount_driven", 1, 0.25), (None, 1, 0.25),
                     ("conditional", 0, 0.0)]
    whole = segments.distribution(segments.bucketize(df.filter("score < 0.5"))).collect()
    assert [r.segment for r in whole] == ["full_price", "conditional", "discount_driven"]


@pytest.mark.parametrize("t1, t2", [(0.5, 0.5), (0.6, 0.5), (0.0, 0.5), (0.2, 1.0)])
def test_thresholds_must_increase(spark, t1, t2):
    df = spark.createDataFrame([(1, 0.1)], "externalcustomerkey int, score double")
    with pytest.raises(ValueError, match="increase"):
        segments.bucketize(df, t1, t2)
    with pytest.raises(ValueError, match="increase"):
        RunConfig(t1=t1, t2=t2)


def test_bucketize_needs_its_columns(spark):
    with pytest.raises(ValueError, match="score"):
        segments.bucketize(spark.range(1).withColumnRenamed("id", "externalcustomerkey"))


def test_settings():
    assert preset("legacy").t2 == 0.6 and preset("current").t2 == 0.5
    for bad in ({"test_size": 0}, {"country_min_share": 2}, {"drop_policy": "x"},
                {"split_mode": "x"}):
        with pytest.raises(ValueError):
            RunConfig(**bad)
    with pytest.raises(ValueError):
        preset("other")


def separable(spark, rows=600):
    """Feature rows where frequent buyers are the coupon users."""
    return spark.range(rows).selectExpr(
        "id as externalcustomerkey", "date'2024-03-31' as as_of_date",
        "id % 10 as orders_12m", "cast(id % 7 as double) as unit_price",
        "if(id % 10 >= 6, 0.5, 0.0) as share_of_orders_with_discount",
        "0.0 as discount_abs_lifetime_eur",
        "if(id % 5 = 0, 'AT', 'St. Lucia') as country",
    )


CFG = RunConfig(boosting=BoostConfig(max_iter=5, max_depth=3, min_instances_per_node=5,
                                     feature_fraction=1.0, subsampling_rate=1.0))


def test_registered_queries_train_with_the_settings_of_the_library():
    from testkit.registry import CONFIG

    assert CONFIG.boosting == BoostConfig() == RunConfig().boosting


def test_run_then_score_again_with_the_saved_folder(spark, tmp_path):
    features = separable(spark)
    model_dir, out = str(tmp_path / "model"), str(tmp_path / "out")
    result = runs.run(spark, features, model_dir, CFG, out)
    assert result.metrics["validation_auc"] > 0.95
    assert result.metrics["n_train"] == 480 and result.metrics["n_val"] == 120
    assert result.metrics["feature_count"] == len(result.metadata.feature_columns) == 4
    assert artifacts.load_metrics(spark, model_dir)["n_val"] == 120

    importance = result.importance.collect()
    assert importance[0].feature == "orders_12m" and importance[0].importance_gain > 0
    assert {r.feature for r in importance} == set(result.metadata.feature_columns)
    assert [r.importance_gain for r in importance] == sorted(
        (r.importance_gain for r in importance), reverse=True)

    # New data with other country shares: the stored metadata decides.
    fresh = features.withColumn("country", F.lit("ZZ")).unionAll(features.limit(1))
    again = runs.score_only(spark, fresh, model_dir, CFG)
    assert again.columns == ["externalcustomerkey", "score", "segment"]
    rows = again.collect()
    assert len(rows) == 601 and all(0 <= r.score <= 1 and r.segment for r in rows)
    written = spark.read.option("header", True).csv(f"{out}/scores_bucketized")
    assert written.columns == ["externalcustomerkey", "score", "segment"]
    assert written.count() == 600


def test_best_round_waits_for_patience():
    assert training.best_round([0.5, 0.6, 0.55, 0.7, 0.69, 0.68], 2) == 4
    assert training.best_round([0.5, 0.6, 0.55, 0.54, 0.7], 2) == 2
    assert training.best_round([0.5, 0.6, 0.7], 1) == 3
    assert training.best_round([1.0], 3) == 1 and training.best_round([None, None], 1) == 1


def test_rounds_follow_the_auc_where_the_loss_says_otherwise(spark, monkeypatch):
    """One fit; the trees kept are those of the best AUC, not of the lowest loss."""
    rows = spark.range(600).selectExpr(
        "id as externalcustomerkey", "cast(id * 7919 % 101 as double) as a",
        "cast(id * 104729 % 97 as double) as b",
        "cast(hash(id) % 5 = 0 or id % 101 < 40 as int) as y_discount_sensitive").cache()
    cfg = CFG.with_changes(boosting=BoostConfig(
        max_iter=8, max_depth=4, min_instances_per_node=1, step_size=1.0,
        early_stopping_rounds=8, feature_fraction=1.0, subsampling_rate=1.0))
    fits = []
    fit = training.GBTClassifier.fit
    monkeypatch.setattr(training.GBTClassifier, "fit",
                        lambda self, *a: fits.append(fit(self, *a)) or fits[-1])
    result = training.train(rows, cfg=cfg)
    assert len(fits) == 1
    whole = fits[0]
    split_rows = split.stratified(rows, fraction=cfg.test_size, seed=cfg.seed)
    held = training.assemble(
        split_rows.filter("is_validation = 1"), ["a", "b"],
        [F.col("y_discount_sensitive").cast("double").alias("label")])
    areas = []
    for k in range(1, whole.getNumTrees + 1):
        scored_rows = training.first_trees(whole, k).transform(held).select(
            training.probability().alias("score"), "label")
        areas.append(metrics.roc_auc(scored_rows).first().auc)
    losses = whole.evaluateEachIteration(held)
    by_loss = losses.index(min(losses)) + 1
    assert result.model.getNumTrees == areas.index(max(areas)) + 1
    assert result.metrics["validation_auc"] == pytest.approx(max(areas), abs=1e-12)
    assert by_loss != result.model.getNumTrees


def test_an_interrupted_save_cannot_be_loaded(spark, tmp_path, monkeypatch):
    features, folder = separable(spark, 200), str(tmp_path / "m")
    meta, _ = runs.fit_model(spark, features, folder, CFG)
    first = artifacts.load_model(spark, folder).uid
    monkeypatch.setattr(artifacts, "write_json_record", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.fit_model(spark, features, folder, CFG)
    monkeypatch.undo()
    assert artifacts.load_model(spark, folder).uid == first
    version = artifacts.trees_path(spark, folder).removesuffix("/trees")
    record = {**meta.to_record(), artifacts.MODEL_UID: "another"}
    artifacts.write_json_record(spark, record, f"{version}/prep_metadata")
    with pytest.raises(ValueError, match="another"):
        artifacts.load_model(spark, folder)


def test_overfitted_rounds_are_dropped(spark):
    noise = spark.range(400).selectExpr(
        "id as externalcustomerkey", "cast(id * 7919 % 101 as double) as a",
        "cast(id * 104729 % 97 as double) as b",
        "cast(hash(id) % 2 = 0 as int) as y_discount_sensitive")
    cfg = CFG.with_changes(boosting=BoostConfig(
        max_iter=6, max_depth=5, min_instances_per_node=1, step_size=0.9, early_stopping_rounds=1,
        feature_fraction=1.0, subsampling_rate=1.0))
    result = training.train(noise, cfg=cfg)
    assert result.metrics["best_iteration"] == result.model.getNumTrees < 6


def test_missing_artifacts_fail(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="metadata"):
        runs.score_only(spark, separable(spark), str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError, match="model"):
        artifacts.load_model(spark, str(tmp_path / "none"))


def test_training_without_metadata_or_key(spark):
    df = separable(spark).selectExpr(
        "orders_12m", "unit_price", "cast(share_of_orders_with_discount > 0 as int)"
        " as y_discount_sensitive")
    assert training.feature_names(df) == ["orders_12m", "unit_price"]
    with pytest.raises(ValueError, match="target"):
        training.feature_names(df.drop("y_discount_sensitive"))
    with pytest.raises(ValueError, match="gone"):
        training.feature_names(df, ["gone"])
    wide = df.withColumn("unit_price", F.rand(3))
    result = training.train(wide, cfg=CFG.with_changes(split_mode="approx"))
    assert result.metrics["feature_count"] == 2 and result.metrics["validation_auc"] > 0.9
