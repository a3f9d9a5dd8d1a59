from datetime import date
from decimal import Decimal as D

from shop_data import AS_OF, bought_by, item, one, order, tables

from promolens.config import FEATURE_FIELDS
from promolens.operators import customers


def test_feature_table_columns_and_types(spark):
    features = customers.feature_table(tables(spark), AS_OF)
    assert [(f.name, f.dataType.simpleString()) for f in features.schema] == list(FEATURE_FIELDS)
    assert len(features.columns) == 47


def test_repeated_number_counts_once_and_sums_twice(spark):
    t = tables(
        spark,
        orders=[order(1, "n", day=date(2024, 3, 30)), order(2, "n", day=date(2023, 1, 1)),
                order(3, "n", "B", day=date(2020, 1, 1))],
        order_items=[item(1, net=10, coupon=-1), item(2, net=30), item(3, net=5)],
        refunds=[(2,)],
        interactions=[bought_by(7, "n")],
    )
    shops = {r.shop: r for r in customers.customer_shop(t, AS_OF).collect()}
    a = shops["A"]
    assert (a.orders_lifetime, a.orders_15d, a.orders_12m) == (1, 1, 1)
    assert a.revenue_lifetime == D("40") and a.revenue_15d == D("10")
    assert (a.discounted_orders, a.discount_abs_lifetime) == (1, D("1"))
    assert (a.refund_orders_lifetime, a.refund_orders_12m) == (1, 0)
    # Both order rows carry the mean piece price of the number.
    assert a.avg_unit_price_lifetime_eur == D("20")
    assert shops["B"].orders_12m == 0 and shops["B"].revenue_12m is None

    row = one(customers.feature_table(t, AS_OF))
    assert (row.orders_lifetime, row.shops_included) == (2, 2)
    assert row.revenue_net_lifetime_eur == 45.0 and row.aov_net_lifetime_eur == 22.5
    assert row.avg_unit_price_lifetime_eur == 12.5  # mean of the shop means 20 and 5
    assert row.share_of_items_discounted == 0.25  # mean of 1/2 and 0
    assert row.refund_rate_lifetime == 0.5 and row.refund_rate_12m == 0.0
    assert row.discount_rate_lifetime == 1 / 46
    assert row.days_since_last_order == 1
    assert row.country is None and row.gender is None
    assert row.account_age_days is None and row.registration_flag == 0


def test_window_lower_bound_is_inclusive(spark):
    days = {1: date(2024, 3, 16), 2: date(2024, 3, 15), 3: date(2024, 3, 1), 4: date(2024, 2, 29),
            5: date(2023, 12, 31), 6: date(2023, 12, 30)}
    t = tables(
        spark,
        orders=[order(i, day=d) for i, d in days.items()],
        order_items=[item(i) for i in days],
        interactions=[bought_by(7, f"N{i}") for i in days],
    )
    row = one(customers.customer_rollup(t, AS_OF))
    assert (row.orders_15d, row.orders_30d, row.orders_3m) == (1, 3, 5)
    assert row.orders_lifetime == 6


def test_no_shop_forms_a_group_without_piece_prices(spark):
    t = tables(spark, orders=[order(1, shop=None)], order_items=[item(1, net=9, quantity=3)],
               interactions=[bought_by(7, "N1")])
    row = one(customers.feature_table(t, AS_OF))
    assert row.shops_included == 0 and row.orders_lifetime == 1
    assert row.avg_unit_price_lifetime_eur is None and row.items_qty_lifetime == 3


def test_zero_quantity_and_zero_revenue_give_no_ratio(spark):
    t = tables(spark, orders=[order(1, day=date(2020, 1, 1))],
               order_items=[item(1, net=0, quantity=0)], interactions=[bought_by(7, "N1")])
    row = one(customers.feature_table(t, AS_OF))
    assert row.share_of_items_discounted is None and row.discount_rate_lifetime is None
    assert row.aov_net_12m_eur is None and row.aov_net_lifetime_eur == 0.0
    assert row.avg_discount_per_order is None and row.share_of_orders_with_discount == 0.0
    assert row.items_qty_12m is None


def test_attributes_take_the_largest_value(spark):
    t = tables(spark, customers=[
        (1, "AT", "Male"), (1, "DE", ""), (2, None, "Female"), (2, None, None), (None, "XX", "Male"),
        (3, "CH", "Female"), (3, "CH", "Male"),
    ])
    found = {r.externalcustomerkey: (r.country, r.gender)
             for r in customers.customer_attributes(t).collect()}
    assert found == {1: ("DE", "Undefined"), 2: (None, "Undefined"), 3: ("CH", "Male")}


def test_unmapped_orders_vanish(spark):
    t = tables(spark, orders=[order(1), order(2)], order_items=[item(1), item(2)],
               interactions=[bought_by(7, "N1")])
    assert one(customers.customer_rollup(t, AS_OF)).orders_lifetime == 1


def test_invariants_and_one_row_per_customer(spark):
    rows = [order(i, f"n{i % 40}", "ABC"[i % 3], date(2023, 1 + i % 12, 1 + i % 28))
            for i in range(120)]
    t = tables(
        spark, orders=rows,
        order_items=[item(i, net=1.0 + i, quantity=i % 4, coupon=-(i % 3)) for i in range(120)],
        refunds=[(i,) for i in range(0, 120, 7)],
        interactions=[bought_by(i % 9, f"n{i}") for i in range(40)],
    )
    found = customers.feature_table(t, AS_OF).collect()
    assert len(found) == len({r.externalcustomerkey for r in found}) == 9
    for r in found:
        counts = [r.orders_15d, r.orders_30d, r.orders_3m, r.orders_6m, r.orders_12m,
                  r.orders_lifetime]
        assert counts == sorted(counts)
        for name in ("share_of_orders_with_discount", "refund_rate_lifetime",
                     "share_of_items_discounted", "discount_rate_lifetime"):
            assert 0 <= r[name] <= 1


def test_piece_share_beyond_64_bit_products(spark):
    t = tables(
        spark, orders=[order(1), order(2)],
        order_items=[item(1, quantity=4e9, coupon=-1), item(2, quantity=8e9)],
        interactions=[bought_by(7, "N1"), bought_by(7, "N2")],
    )
    assert one(customers.feature_table(t, AS_OF)).share_of_items_discounted == 0.333333333


def test_returns_can_turn_the_piece_share_negative(spark):
    t = tables(
        spark, orders=[order(1), order(2)],
        order_items=[item(1, quantity=-1, coupon=-1), item(2, quantity=-2)],
        interactions=[bought_by(7, "N1"), bought_by(7, "N2")],
    )
    row = one(customers.feature_table(t, AS_OF))
    assert row.share_of_items_discounted == 0.333333333 and row.items_qty_lifetime == -3
