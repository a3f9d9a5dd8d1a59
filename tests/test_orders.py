from collections import Counter
from dataclasses import replace
from datetime import date, datetime
from decimal import ROUND_HALF_UP, localcontext
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from shop_data import AS_OF, bought_by, item, one, order, tables

from promolens.functions.expr import months_before, window_start
from promolens.operators import orders


def test_calendar_steps_clip_to_month_ends():
    assert months_before(date(2024, 3, 31), 1) == date(2024, 2, 29)
    assert months_before(date(2024, 2, 29), 60) == date(2019, 2, 28)
    assert window_start(date(2024, 3, 31), "15d") == date(2024, 3, 16)
    assert window_start(date(2024, 3, 31), "6m") == date(2023, 9, 30)


def test_order_filter_keeps_both_end_days_and_trims_the_test_flag(spark):
    start = orders.lookback_start(AS_OF)
    t = tables(spark, orders=[
        order(1, day=AS_OF), order(2, day=start), order(3, day=date(2024, 4, 1)),
        order(4, day=date(2019, 3, 30)), order(5, test=" 0 "), order(6, test=None),
        order(7, test="1"), order(8, state="CANCELLED"), order(9, state="ARCHIVED"),
        order(10, state=None),
    ])
    assert start == date(2019, 3, 31)
    kept = {r.order_id for r in orders.orders_base(t, AS_OF).collect()}
    assert kept == {1, 2, 5, 9}


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "string"])
def test_order_filter_accepts_every_date_type(spark, kind):
    t = tables(spark, orders=[order(1, day=AS_OF), order(2, day=date(2024, 4, 1))])
    late = t.orders.selectExpr(
        "* except (created_date)",
        f"cast(concat(cast(created_date as string), ' 23:59:59') as {kind}) as created_date"
        if kind != "date" else "created_date",
    )
    t = type(t)(**{n: late if n == "orders" else getattr(t, n) for n in t.names()})
    rows = orders.orders_base(t, AS_OF).collect()
    assert [(r.order_id, r.order_date) for r in rows] == [(1, AS_OF)]


def test_missing_source_column_is_reported(spark):
    t = tables(spark)
    with pytest.raises(ValueError, match="refunds lacks"):
        type(t)(**{n: getattr(t, n).drop("orderid") if n == "refunds" else getattr(t, n)
                   for n in t.names()})


def test_rates_zero_is_no_rate_and_does_not_fall_back(spark):
    day = date(2024, 3, 1)
    t = tables(
        spark,
        orders=[order(1, rate=0.0), order(2, rate=None), order(3, rate=None, currency="SEK"),
                order(4, rate=2.0), order(5, rate=None, currency="CHF")],
        order_items=[item(i, net=10.0, coupon=-1.0) for i in range(1, 6)],
        currency_rates=[("EUR", day, 4.0), ("CHF", day, 0.0)],
    )
    lines = {r.order_id: r for r in orders.priced_lines(t, AS_OF).collect()}
    assert lines[1].post_discount_net_eur is None and lines[1].discount_amt_eur is None
    assert lines[2].post_discount_net_eur == D("2.5") and lines[2].discount_amt_eur == D("0.25")
    assert lines[3].post_discount_net_eur is None
    assert lines[4].post_discount_net_eur == D("5")
    assert lines[5].post_discount_net_eur is None


def test_duplicate_rates_repeat_lines_and_are_reported(spark):
    day = date(2024, 3, 1)
    t = tables(
        spark,
        orders=[order(1, rate=None), order(2, rate=1.0)],
        order_items=[item(1), item(2)],
        currency_rates=[("EUR", day, 2.0), ("EUR", day, 4.0)],
    )
    net = sorted((r.order_id, r.post_discount_net_eur)
                 for r in orders.priced_lines(t, AS_OF).collect())
    assert net == [(1, D("2.5")), (1, D("5")), (2, D("10")), (2, D("10"))]
    report = one(orders.rate_duplicates(t), currencycode="EUR")
    assert (report.rates, report.days, report.duplicated_days) == (2, 1, 1)


def test_decimal_amounts_are_divided_exactly(spark):
    """Two-decimal amounts at rates whose quotients end in a half, which a double misses."""
    cents = [2001 + 7 * i for i in range(3000)]
    for rate in ("1.28", "10.24", "0.96"):
        t = tables(
            spark,
            orders=[order(1, rate=1.0)],
            order_items=[item(1, net=c / 100) for c in cents],
        )
        t = replace(
            t,
            orders=t.orders.withColumn("currencyrate", F.lit(D(rate)).cast("decimal(12,4)")),
            order_items=t.order_items.withColumn(
                "nettotalprice", F.col("nettotalprice").cast("decimal(12,2)")
            ).withColumn("coupondiscountdistr", -F.col("nettotalprice")),
            currency_rates=t.currency_rates.withColumn(
                "currencyrate", F.col("currencyrate").cast("decimal(10,2)")
            ),
        )
        rows = orders.priced_lines(t, AS_OF).collect()
        with localcontext() as context:
            context.prec = 50
            expected = Counter(
                (D(c) / 100 / D(rate)).quantize(D("0.000001"), ROUND_HALF_UP) for c in cents
            )
        assert Counter(r["post_discount_net_eur"] for r in rows) == expected
        assert Counter(r["discount_amt_eur"] for r in rows) == expected


def test_latest_customer_of_whole_number_keys_needs_no_sort(spark, capsys):
    t = tables(spark, interactions=[
        ("order", "N1", -5, datetime(2024, 1, 1)), ("order", "N1", -7, datetime(2024, 1, 1)),
        ("order", "N2", 3, None), ("order", "N2", 9, datetime(2030, 1, 1)),
        ("order", "N3", 2**62, datetime(1950, 1, 1)), ("order", "N3", 1, datetime(1949, 1, 1)),
    ])
    found = orders.order_customer_map(t)
    assert dict(map(tuple, found.collect())) == {"N1": -5, "N2": 3, "N3": 2**62}
    found.explain()
    plan = capsys.readouterr().out
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_line_types_quantities_and_piece_prices(spark):
    t = tables(
        spark,
        orders=[order(1)],
        order_items=[
            item(1, net=10.0, quantity=3.0), item(1, net=-10.0, quantity=3.0),
            item(1, net=5.0, quantity=2.5), item(1, net=None, quantity=1.0),
            item(1, net=7.0, quantity=None), item(1, net=4.0, type="SHIPPING"),
            item(1, net=99.0, type="GIFTCARD"),
        ],
    )
    found = [(r.quantity, r.net_amount_eur, r.unit_price_net_eur)
             for r in orders.product_lines(t, AS_OF).collect()]
    assert sorted(found, key=str) == sorted([
        (3, D("10"), D("3.333333")), (3, D("-10"), D("-3.333333")), (3, D("5"), D("1.666667")),
        (1, D("0"), D("0")), (0, D("7"), None),
    ], key=str)
    totals = one(orders.order_level(t, AS_OF))
    assert totals.product_net == D("12") and totals.shipping_net == D("4")
    assert totals.revenue_net == D("16") and totals.product_qty == 10


def test_order_without_any_rate_has_null_product_net_but_zero_revenue(spark):
    t = tables(spark, orders=[order(1, rate=0.0)], order_items=[item(1, coupon=-2.0)])
    row = one(orders.order_level(t, AS_OF))
    assert row.product_net is None and row.shipping_net == 0
    assert row.revenue_net == 0 and row.discount_amt_eur == 0


def test_amount_beyond_the_decimal_range_fails(spark):
    t = tables(spark, orders=[order(1)], order_items=[item(1, net=2e12)])
    with pytest.raises(Exception, match="does not fit"):
        orders.priced_lines(t, AS_OF).collect()


def test_refund_flag_ignores_repeats(spark):
    t = tables(spark, orders=[order(1), order(2)], order_items=[item(1), item(2)],
               refunds=[(1,), (1,), (9,)])
    flags = {r.order_id: r.refunded_flag for r in orders.order_level(t, AS_OF).collect()}
    assert flags == {1: 1, 2: 0}


def test_latest_interaction_wins_and_a_missing_time_counts_as_latest(spark):
    early, late = datetime(2024, 1, 1), datetime(2024, 2, 1)
    t = tables(spark, interactions=[
        bought_by(1, "a", early), bought_by(2, "a", late),
        bought_by(3, "b", late), bought_by(4, "b", None),
        bought_by(5, "c", late), bought_by(6, "c", late),
        bought_by(None, "d", late), bought_by(7, "d", early),
        bought_by(8, "e", early, kind="visit"), bought_by(9, None, early),
    ])
    found = dict(map(tuple, orders.order_customer_map(t).collect()))
    assert found == {"a": 2, "b": 4, "c": 6, "d": 7}


def test_mapped_orders_join_prices_by_shop_and_number(spark):
    t = tables(
        spark,
        orders=[order(1, "n", "A"), order(2, "n", "B"), order(3, "n", None), order(4, "x", "A"),
                order(5, "n", "A")],
        order_items=[item(1, net=10), item(2, net=20), item(3, net=30), item(4, net=40),
                     item(5, net=20)],
        interactions=[bought_by(7, "n")],
    )
    rows = orders.orders_mapped(t, AS_OF).collect()
    found = sorted((r.shop or "", r.revenue_net, r.avg_unit_price_order_eur) for r in rows)
    assert found == [("", D("30"), None), ("A", D("10"), D("15")), ("A", D("20"), D("15")),
                     ("B", D("20"), D("20"))]
    assert {r.externalcustomerkey for r in rows} == {7}
