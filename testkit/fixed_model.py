"""A small boosted ensemble with known thresholds, in the layout of a trained one."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession

from promolens.operators.prepare import PrepMetadata

# (weight, tree); a tree is a leaf value or (feature, threshold, at most, above).
TREES = (
    (1.0, ("orders_lifetime", 3.0, -0.5, 0.75)),
    (0.5, ("items_qty_12m", 40.0, ("days_since_last_order", 200.0, 0.25, -0.375), 1.0)),
    (0.25, ("refund_orders_lifetime", 0.0, 0.125, ("orders_12m", 2.0, -1.0, 0.5))),
)


def fixed_model(spark: SparkSession, meta: PrepMetadata) -> GBTClassificationModel:
    gateway = spark.sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    names = list(meta.feature_columns)

    def counted():
        stats = gateway.new_array(gateway.jvm.double, 3)
        return gateway.jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(stats, 1)

    def node(tree):
        if not isinstance(tree, tuple):
            return ml.tree.LeafNode(tree, 0.0, counted())
        feature, threshold, low, high = tree
        split = ml.tree.ContinuousSplit(names.index(feature), threshold)
        return ml.tree.InternalNode(0.0, 0.0, 1.0, node(low), node(high), split, counted())

    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(TREES))
    weights = gateway.new_array(gateway.jvm.double, len(TREES))
    for i, (weight, tree) in enumerate(TREES):
        trees[i] = ml.regression.DecisionTreeRegressionModel(f"fixed{i}", node(tree), len(names))
        weights[i] = weight
    java = ml.classification.GBTClassificationModel("fixed", trees, weights, len(names), 2)
    return GBTClassificationModel(java)


def case_sql(tree) -> str:
    """The value of a tree as a SQL expression over feature columns."""
    if not isinstance(tree, tuple):
        return f"CAST({tree} AS DOUBLE)"
    feature, threshold, low, high = tree
    return f"CASE WHEN {feature} <= {threshold} THEN {case_sql(low)} ELSE {case_sql(high)} END"


def score_sql() -> str:
    margin = " + ".join(f"{weight} * ({case_sql(tree)})" for weight, tree in TREES)
    return f"round(1 / (1 + exp(-2 * ({margin}))), 9)"


def splits_of(tree) -> list[str]:
    """The feature of every split of a tree."""
    if not isinstance(tree, tuple):
        return []
    feature, _, low, high = tree
    return [feature, *splits_of(low), *splits_of(high)]


def importance_sql(names: list[str]) -> str:
    """Gain and splits of each feature: every split of the ensemble has gain 1 and one row."""
    used = [feature for _, tree in TREES for feature in splits_of(tree)]
    rows = ", ".join(f"('{n}', {used.count(n)})" for n in names)
    return (
        "SELECT feature, CAST(n AS DOUBLE) AS importance_gain, CAST(n AS BIGINT) AS importance_split"
        f" FROM (VALUES {rows}) AS v(feature, n)"
        " UNION ALL SELECT 'country', 0, 0 FROM flags"
    )
