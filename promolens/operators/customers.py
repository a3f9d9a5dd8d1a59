"""Customer-and-shop aggregates, customer roll-up, and the wide feature table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from promolens.config import FEATURE_FIELDS, ID_COLUMN
from promolens.functions.expr import WINDOWS, sql_columns, day, ratio, since
from promolens.functions.money import (
    as_money,
    divide_half_up,
    mean_micros,
    merge_sum,
    share_half_up,
    start_sum,
    total,
)
from promolens.operators.orders import (
    PIECE_WINDOWS,
    REVENUE_WINDOWS,
    number_totals,
    order_customer_map,
    order_rows,
)
from promolens.sources.tables import SourceTables

UNKNOWN_GENDER = "Undefined"  # fixed value
REVENUES = ("lifetime", *REVENUE_WINDOWS)
PIECES = ("lifetime", *PIECE_WINDOWS)
REFUNDS = ("lifetime", "3m", "6m", "12m")
COUNTS = (
    "orders_lifetime",
    *(f"orders_{w}" for w in WINDOWS),
    *(f"items_qty_{w}" for w in PIECES),
    "discounted_orders",
    *(f"refund_orders_{w}" for w in REFUNDS),
)
RENAMED = {"discounted_orders": "discounted_orders_lifetime"}

PRICE_MEAN = mean_micros("price_sum", "price_n")
# Shares are whole billionths, rounded half up.
BILLIONTHS = 1_000_000_000
PIECE_SHARE = share_half_up("pieces_couponed", "items_qty_lifetime", BILLIONTHS)


def _as_share(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,0)) * 0.000000001 AS DECIMAL(18,9))"


PRICES_IN_EUR = (
    f"{as_money(PRICE_MEAN)} AS avg_unit_price_lifetime_eur",
    f"{as_money('price_min')} AS min_unit_price_lifetime_eur",
    f"{as_money('price_max')} AS max_unit_price_lifetime_eur",
)


def _shop_parts(tables: SourceTables, as_of: date) -> DataFrame:
    """One row per customer and shop, money still as started sums.

    Built on rows that are already distinct by order number, so distinct counts are plain
    conditional counts, and the piece share comes out of the same pass.
    """
    numbers = number_totals(order_rows(tables, as_of), as_of)
    mapped = numbers.join(order_customer_map(tables), "ordernumber")

    def numbers_since(column: str, window: str) -> str:
        return f"count_if({since(column, as_of, window)})"

    # The mean runs over order rows: a number with n rows counts n times.
    return mapped.groupBy(ID_COLUMN, "shop").agg(
        *sql_columns(
            "min(first_day) AS first_order_date",
            "max(last_day) AS last_order_date",
            "count(1) AS orders_lifetime",
            *(f"{numbers_since('last_day', w)} AS orders_{w}" for w in WINDOWS),
            *(c for w in REVENUES for c in merge_sum(f"revenue_{w}")),
            *(f"sum(pieces_{w}) AS items_qty_{w}" for w in PIECES),
            *merge_sum("coupon"),
            "count_if(coupon_max > 0) AS discounted_orders",
            "max(coupon_max) AS coupon_max",
            "count(last_refunded_day) AS refund_orders_lifetime",
            *(
                f"{numbers_since('last_refunded_day', w)} AS refund_orders_{w}"
                for w in REFUNDS[1:]
            ),
            *start_sum("price_mean", "price_sum", weight="order_rows"),
            "sum(order_rows) FILTER (WHERE price_mean IS NOT NULL) AS price_n",
            "min(price_min) AS price_min",
            "max(price_max) AS price_max",
            "sum(pieces_couponed) AS pieces_couponed",
        )
    )


def customer_shop(tables: SourceTables, as_of: date) -> DataFrame:
    """One row per customer and shop: counts, revenue, pieces, coupons, refunds, prices."""
    return _shop_parts(tables, as_of).selectExpr(
        ID_COLUMN,
        "shop",
        "first_order_date",
        "last_order_date",
        *COUNTS,
        *(f"{total(f'revenue_{w}')} AS revenue_{w}" for w in REVENUES),
        f"{total('coupon')} AS discount_abs_lifetime",
        "coupon_max AS max_discount_single_order",
        *PRICES_IN_EUR,
        f"{_as_share(PIECE_SHARE)} AS share_of_items_discounted",
    )


def shop_item_share(tables: SourceTables, as_of: date) -> DataFrame:
    """Share of pieces bought in coupon orders, per customer and shop."""
    return customer_shop(tables, as_of).select(ID_COLUMN, "shop", "share_of_items_discounted")


def customer_rollup(tables: SourceTables, as_of: date) -> DataFrame:
    """One row per customer; means over shops are unweighted."""
    per_shop = _shop_parts(tables, as_of).selectExpr(
        "*", f"{PRICE_MEAN} AS price_mean", f"{PIECE_SHARE} AS share"
    )
    folded = per_shop.groupBy(ID_COLUMN).agg(
        *sql_columns(
            "min(first_order_date) AS first_order_date",
            "max(last_order_date) AS last_order_date",
            *(f"sum({c}) AS {c}" for c in COUNTS),
            *(c for w in REVENUES for c in merge_sum(f"revenue_{w}")),
            *merge_sum("coupon"),
            "max(coupon_max) AS coupon_max",
            *start_sum("price_mean", "price_sum"),
            "count(price_mean) AS price_n",
            "min(price_min) AS price_min",
            "max(price_max) AS price_max",
            "count(shop) AS shops_included",
            "sum(share) AS share_sum",
            "count(share) AS share_n",
        )
    )
    mean_share = f"CASE WHEN share_n > 0 THEN {divide_half_up('share_sum', 'share_n')} END"
    return folded.selectExpr(
        ID_COLUMN,
        "first_order_date",
        "last_order_date",
        *(f"{c} AS {RENAMED.get(c, c)}" for c in COUNTS),
        *(f"{total(f'revenue_{w}')} AS revenue_net_{w}_eur" for w in REVENUES),
        f"{total('coupon')} AS discount_abs_lifetime_eur",
        "coupon_max AS max_discount_single_order",
        *PRICES_IN_EUR,
        "shops_included",
        f"{_as_share(mean_share)} AS share_of_items_discounted",
    )


def customer_item_share(tables: SourceTables, as_of: date) -> DataFrame:
    """Unweighted mean over shops of the coupon piece share."""
    return customer_rollup(tables, as_of).select(ID_COLUMN, "share_of_items_discounted")


def customer_attributes(tables: SourceTables) -> DataFrame:
    """Country and gender per customer, the alphabetically last where rows differ."""
    return (
        tables.customers.filter(f"{ID_COLUMN} IS NOT NULL")
        .groupBy(ID_COLUMN)
        .agg(
            *sql_columns(
                "max(country) AS country",
                f"max(coalesce(nullif(gender, ''), '{UNKNOWN_GENDER}')) AS gender",
            )
        )
    )


def feature_table(tables: SourceTables, as_of: date) -> DataFrame:
    """The 47-column feature table, one row per customer."""
    gross = "(revenue_net_lifetime_eur + discount_abs_lifetime_eur)"
    derived = {
        "as_of_date": day(as_of),
        "days_since_last_order": f"datediff({day(as_of)}, last_order_date)",
        "discount_rate_lifetime": ratio("discount_abs_lifetime_eur", gross),
        "share_of_orders_with_discount": ratio("discounted_orders_lifetime", "orders_lifetime"),
        "avg_discount_per_order": ratio("discount_abs_lifetime_eur", "discounted_orders_lifetime"),
        "account_age_days": "NULL",
        "registration_flag": "0",
    }
    for w in ("lifetime", "12m", "6m"):
        derived[f"aov_net_{w}_eur"] = ratio(f"revenue_net_{w}_eur", f"orders_{w}")
        derived[f"avg_items_per_order_{w}"] = ratio(f"items_qty_{w}", f"orders_{w}")
    for w in REFUNDS:
        derived[f"refund_rate_{w}"] = ratio(f"refund_orders_{w}", f"orders_{w}")

    wide = customer_rollup(tables, as_of).join(customer_attributes(tables), ID_COLUMN, "left")
    return wide.selectExpr(
        ID_COLUMN,
        *(
            f"CAST({derived.get(name, name)} AS {kind}) AS {name}"
            for name, kind in FEATURE_FIELDS[1:]
        ),
    )
