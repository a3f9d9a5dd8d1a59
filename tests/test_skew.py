"""One order, order number or customer may hold a third of all rows."""

from contextlib import contextmanager
from datetime import date

import pytest
from compare import difference, duckdb_over
from pyspark.sql import functions as F
from shop_data import AS_OF, tables

from promolens.operators import customers, orders
from testkit import views
from testkit.registry import plain


@contextmanager
def settings(spark, **values):
    for key, value in values.items():
        spark.conf.set(f"spark.sql.adaptive.{key.replace('__', '.')}", value)
    try:
        yield
    finally:
        for key in values:
            spark.conf.unset(f"spark.sql.adaptive.{key.replace('__', '.')}")


def skewed(spark, rows=60000):
    """A third of the lines on order 0, a third of the orders on number HOT and customer 1."""
    base = tables(spark)
    n_orders = rows // 4
    made = {
        "orders": spark.range(n_orders).selectExpr(
            "id", "if(id % 3 = 0, 'HOT', concat('n', id)) as ordernumber",
            "element_at(array('A', 'B', null), cast(id % 3 + 1 as int)) as shop",
            "date_sub(date'2024-03-31', cast(id % 900 as int)) as created_date",
            "'EUR' as currency_code", "cast(1.25 as double) as currencyrate", "'0' as testorder",
            "'EXPORTED' as state"),
        "order_items": spark.range(rows, numPartitions=8).selectExpr(
            f"if(id % 3 = 0, 0, (id div 3) % {n_orders}) as orderid",
            "if(id % 11 = 0, 'SHIPPING', 'PRODUCT') as type",
            "cast(id % 5 as double) as quantity", "cast(id % 997 as double) as nettotalprice",
            "if(id % 10 = 0, cast(-(id % 7) as double), null) as coupondiscountdistr"),
        "refunds": spark.range(rows).selectExpr("if(id % 3 = 0, 0, id % 777) as orderid"),
        "interactions": spark.range(n_orders).selectExpr(
            "'order' as interaction_type",
            "if(id % 3 = 0, 'HOT', concat('n', id)) as related_ordernumber",
            "if(id % 3 = 0, 1, 2 + id % 50) as external_customerkey",
            "cast(null as timestamp) as event_time"),
    }
    return type(base)(**{n: made.get(n, getattr(base, n)) for n in base.names()})


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The skewed tables as files, for both engines."""
    root = tmp_path_factory.mktemp("skew")
    t = skewed(spark)
    for name in t.names():
        getattr(t, name).coalesce(4).write.parquet(str(root / f"{name}.parquet"))
    return type(t)(**{n: spark.read.parquet(str(root / f"{n}.parquet")) for n in t.names()}), root


def test_a_hot_order_is_split_by_the_adaptive_join(spark, written):
    t, _ = written
    limits = {
        "skewJoin__skewedPartitionThresholdInBytes": "32KB",
        "skewJoin__skewedPartitionFactor": "2",
        "advisoryPartitionSizeInBytes": "32KB",
    }
    expected = {r.order_id: r for r in orders.order_level(t, AS_OF).collect()}
    with settings(spark, **limits):
        df = orders.order_level(t, AS_OF)
        rows = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert {r.order_id: r for r in rows} == expected
    lines_of_hot = t.order_items.filter("orderid = 0")
    net = lines_of_hot.agg(F.sum("nettotalprice")).first()[0]
    assert float(expected[0].revenue_net) == pytest.approx(net / 1.25, abs=0.01)
    assert expected[0].refunded_flag == 1


@pytest.fixture(scope="module")
def direct(written):
    """The direct-form SQL over the same files."""
    from testkit import oracle

    _, root = written
    duck = duckdb_over("/nonexistent")
    for name in views.VIEW_SQL:
        duck.execute(f"CREATE VIEW src_{name} AS"
                     f" SELECT * FROM read_parquet('{root}/{name}.parquet/*.parquet')")

    def sql(name):
        text = oracle.with_ctes(oracle.SELECTS[name])
        for view in views.VIEW_SQL:
            text = text.replace(f"src_{view} AS ({views.duckdb_view(view)})",
                                f"own_{view} AS (SELECT 1)")
        return text.replace(str(views.AS_OF), str(AS_OF))

    return duck, sql


@pytest.mark.parametrize("name, step", [
    ("order_level", orders.order_level), ("orders_mapped", orders.orders_mapped),
    ("cust_shop", customers.customer_shop), ("feature_table", customers.feature_table),
])
def test_skewed_tables_equal_the_direct_sql(written, direct, name, step):
    duck, sql = direct
    assert difference(plain(step(written[0], AS_OF)), duck, sql(name)) is None


def test_hot_number_is_spread_over_tasks(spark, written):
    mapped = orders.orders_mapped(written[0], AS_OF).filter("ordernumber = 'HOT'")
    with settings(spark, enabled="false"):
        spread = orders.orders_mapped(written[0], AS_OF).filter("ordernumber = 'HOT'")
        sizes = [r[1] for r in spread.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)
    assert mapped.count() == sum(sizes) == 5000


def test_dates_of_the_fixture_hit_every_window(written):
    row = customers.customer_rollup(written[0], AS_OF).filter("externalcustomerkey = 1").first()
    assert row.orders_lifetime == row.orders_15d >= 1
    assert row.last_order_date == date(2024, 3, 31)
