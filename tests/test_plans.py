"""The physical plans keep the shapes the job is designed for."""

from shop_data import AS_OF, tables

from promolens.operators import customers, orders


def plan(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = df()
        return fresh._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_feature_table_has_eleven_shuffles_and_no_row_multiplication(spark):
    t = tables(spark)
    text = plan(spark, lambda: customers.feature_table(t, AS_OF))
    for shape in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python"):
        assert shape not in text
    # orders and rates by currency and day (none if statistics allow a broadcast); orders,
    # lines, refunds by order; numbers; numbers and interactions by number; customer and shop;
    # customer; customer attributes.
    assert text.count("Exchange hashpartitioning") == 11
    assert "SinglePartition" not in text


def test_order_rows_shuffle_each_side_once(spark):
    t = tables(spark)
    text = plan(spark, lambda: orders.order_rows(t, AS_OF))
    assert text.count("Exchange hashpartitioning") == 5


def test_mapped_orders_join_the_lines_once(spark):
    """The rows are written once, so what is planned after that reads no line table at all."""
    t = tables(spark)
    text = plan(spark, lambda: orders.orders_mapped(t, AS_OF))
    assert "coupondiscountdistr" not in text and "nettotalprice" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    t = tables(spark)
    path = str(tmp_path / "orders")
    t.orders.withColumn("unused", t.orders.shop).write.parquet(path)
    stored = {n: spark.read.parquet(path) if n == "orders" else getattr(t, n) for n in t.names()}
    text = plan(spark, lambda: orders.orders_base(type(t)(**stored), AS_OF))
    pushed = text[text.index("PushedFilters"):]
    assert "GreaterThanOrEqual(created_date,2019-03" in pushed  # the plan text is shortened
    assert "In(state, [ARCHIVED,EXPORTED])" in pushed
    assert "unused" not in pushed[pushed.index("ReadSchema"):]
