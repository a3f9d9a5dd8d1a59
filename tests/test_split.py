"""Edges of the split and of the AUC."""

import pytest
from pyspark.sql import functions as F

from promolens.operators import metrics, split


def frame(spark, n=200):
    return spark.range(n).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("externalcustomerkey"),
        (F.col("id") % 4 == 0).cast("int").alias("y"),
        F.col("id").alias("x"),
    )


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_rows_without_a_key_are_on_one_side(spark, mode):
    out = split.stratified(frame(spark), label="y", mode=mode)
    assert out.where("is_validation is null").count() == 0
    missing = out.where("externalcustomerkey is null")
    assert {r[0] for r in missing.select("is_validation").distinct().collect()} == {0, 1}
    if mode == "exact":
        assert out.where("is_validation = 1").count() == 40


def test_a_missing_label_is_refused(spark):
    df = frame(spark).withColumn("y", F.expr("if(x = 7, NULL, y)"))
    with pytest.raises(Exception, match="has no label"):
        split.stratified(df, label="y").collect()


def test_a_label_with_many_values_is_refused(spark):
    with pytest.raises(ValueError, match="more than"):
        split.stratified(frame(spark).withColumn("y", F.col("x")), label="y")


def test_auc_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "score double, label int")
    assert metrics.roc_auc(empty).first()["auc"] is None
    one = spark.createDataFrame([(0.5, 1)], "score double, label int")
    assert metrics.roc_auc(one).first()["auc"] is None
    two = spark.createDataFrame([(0.5, 1), (0.5, 0)], "score double, label int")
    assert metrics.roc_auc(two).first()["auc"] == 0.5
