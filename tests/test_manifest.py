import pytest
from pyspark.sql import functions as F

from promolens.config import BoostConfig, RunConfig
from promolens.plans import runs
from promolens.plans.manifest import Manifest, fingerprint, table_fingerprint
from promolens.sources import sinks
from testkit import registry

SF = "/root/testdata/sf0.001"
CFG = RunConfig(boosting=BoostConfig(max_iter=2, max_depth=2))


def test_fingerprint_of_rows_ignores_order_and_files_only(spark):
    df = spark.createDataFrame([(1, None, 2.0), (1, None, 2.0), (2, "a", None)],
                               "a int, `b.c` string, d double")
    first = table_fingerprint(df)
    assert table_fingerprint(df.repartition(3).orderBy(F.desc("a"))) == first
    others = [
        df.dropDuplicates(), df.withColumn("d", F.lit(2.0)), df.withColumnRenamed("d", "e"),
        df.unionAll(df.limit(1)), df.where("false"), df.where("a = 2").unionAll(df.where("a = 2")),
    ]
    assert len({first, *(table_fingerprint(o) for o in others)}) == 1 + len(others)


def test_a_null_counts_by_its_place(spark):
    one = spark.createDataFrame([(None, 5)], "a int, b int")
    other = spark.createDataFrame([(5, None)], "a int, b int")
    assert table_fingerprint(one) != table_fingerprint(other)


def test_a_step_without_record_is_done_again(spark, tmp_path):
    def broken(path):
        spark.range(3).write.parquet(path)
        raise RuntimeError("lost")

    def whole(path):
        spark.range(5).write.mode("overwrite").parquet(path)

    steps = Manifest(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        steps.step("s", fingerprint(1), broken)
    assert spark.read.parquet(steps.step("s", fingerprint(1), whole)).count() == 5
    assert spark.read.parquet(steps.step("s", fingerprint(1), broken)).count() == 5
    assert steps.built == ["s"] and steps.reused == ["s"]
    with pytest.raises(RuntimeError):
        steps.step("s", fingerprint(2), broken)
    with pytest.raises(FileNotFoundError):
        steps.published()


def test_an_empty_record_counts_as_absent(spark, tmp_path):
    steps = Manifest(spark, str(tmp_path))
    path = steps.step("s", "x", lambda path: None)
    done = path.replace("/data", "/done")
    spark.range(0).selectExpr("'' as v").write.mode("overwrite").text(done)
    steps.step("s", "x", lambda path: None)
    assert steps.built == ["s", "s"]


def test_a_broken_run_goes_on_without_a_second_fit(spark, tmp_path, monkeypatch):
    features = registry.features(spark, SF)
    fits, fit = [], runs.fit_model
    monkeypatch.setattr(runs, "fit_model", lambda *a: fits.append(a) or fit(*a))
    cut = runs.segments.bucketize

    def fail(*_):
        raise RuntimeError("executors lost")

    monkeypatch.setattr(runs.segments, "bucketize", fail)
    with pytest.raises(RuntimeError, match="lost"):
        runs.run_resumable(spark, features, str(tmp_path), CFG)
    with pytest.raises(FileNotFoundError):
        Manifest(spark, str(tmp_path)).published()
    monkeypatch.setattr(runs.segments, "bucketize", cut)
    result, steps = runs.run_resumable(spark, features, str(tmp_path), CFG)
    assert len(fits) == 1
    assert steps.reused == ["train", "importance", "scores", "scores_csv"]
    assert steps.built == ["segments", "segments_csv"]
    out = steps.published()
    assert spark.read.csv(out["scores"], header=True).columns == ["externalcustomerkey", "score"]
    assert result.segments.count() == features.count()
    assert result.metrics["n_train"] > 0 and result.importance.count() > 0

    changed = features.withColumn("orders_15d", F.col("orders_15d") + 1)
    _, again = runs.run_resumable(spark, changed, str(tmp_path), CFG)
    assert len(fits) == 2 and again.reused == []
    _, skipped = runs.run_resumable(
        spark, features, str(tmp_path / "other"), CFG, True, out["model"]
    )
    assert len(fits) == 2 and "train" not in skipped.built
    before = spark.read.csv(out["scores_bucketized"], header=True)
    after = spark.read.csv(skipped.published()["scores_bucketized"], header=True)
    assert before.exceptAll(after).count() == 0 and after.count() == before.count()
    with pytest.raises(ValueError, match="model_dir"):
        runs.run_resumable(spark, features, str(tmp_path), CFG, skip_training=True)


def test_scores_have_a_csv_of_their_own(spark, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(sinks, "write_csv", lambda df, path: written.append((df.columns, path)))
    runs.run(spark, registry.features(spark, SF), str(tmp_path / "m"), CFG, "out")
    assert (["externalcustomerkey", "score"], "out/scores") in written
