"""Order lines in one currency, order totals, refunds and the order-to-customer map."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import ID_COLUMN, LOOKBACK_YEARS
from promolens.functions.expr import (
    WINDOWS,
    sql_columns,
    day,
    falls_between,
    months_before,
    since,
    window_start,
)
from promolens.functions.money import (
    as_money,
    divide_half_up,
    is_positive,
    mean_micros,
    merge_sum,
    micros,
    quotient_micros,
    start_sum,
    total,
)
from promolens.session import stage
from promolens.sources.tables import SourceTables

# Which orders, lines and interactions count.
FINAL_STATES = ("ARCHIVED", "EXPORTED")
REGULAR_ORDER = "0"
PRODUCT, SHIPPING = "PRODUCT", "SHIPPING"
ORDER_INTERACTION = "order"
REVENUE_WINDOWS = ("15d", "30d", "6m", "12m")
PIECE_WINDOWS = ("6m", "12m")

# A hot order number is split this many ways; a normal one never sees more than its rows.
SALTS = 1024


def lookback_start(as_of: date) -> date:
    return months_before(as_of, 12 * LOOKBACK_YEARS)


def lookback_windows(tables: SourceTables, as_of: date) -> DataFrame:
    """The date bounds of every look-back, with the orders that fall inside each."""
    bounds = {"lifetime": lookback_start(as_of), **{w: window_start(as_of, w) for w in WINDOWS}}
    counted = orders_base(tables, as_of).agg(
        *sql_columns(*(f"count_if(order_date >= {day(d)}) AS n_{w}" for w, d in bounds.items()))
    )
    rows = ", ".join(
        f"struct('{w}' AS window_name, {day(as_of)} AS as_of_date, {day(d)} AS start_date,"
        f" n_{w} AS orders_in_window)"
        for w, d in bounds.items()
    )
    return counted.selectExpr(f"inline(array({rows}))")


def orders_base(tables: SourceTables, as_of: date) -> DataFrame:
    """Finished, non-test orders of the look-back, both end days included."""
    orders = tables.orders
    return orders.filter(
        (F.trim(F.col("testorder").cast("string")) == REGULAR_ORDER)
        & F.col("state").isin(*FINAL_STATES)
        & falls_between(orders, "created_date", lookback_start(as_of), as_of)
    ).selectExpr(
        "id AS order_id",
        "ordernumber",
        "shop",
        "CAST(created_date AS DATE) AS order_date",
        "currency_code",
        "currencyrate AS order_currencyrate",
    )


def daily_rates(tables: SourceTables) -> DataFrame:
    """Exchange rates per currency and day, exactly as delivered."""
    return tables.currency_rates.selectExpr(
        "currencycode", "CAST(date AS DATE) AS rate_date", "currencyrate"
    )


def rate_duplicates(tables: SourceTables) -> DataFrame:
    """Per currency: rates, days, and days with several rates (each would repeat lines)."""
    per_day = daily_rates(tables).groupBy("currencycode", "rate_date").agg(F.expr("count(1) AS n"))
    return per_day.groupBy("currencycode").agg(
        *sql_columns("sum(n) AS rates", "count(1) AS days", "count_if(n > 1) AS duplicated_days")
    )


def _scale(df: DataFrame, name: str) -> int | None:
    """Digits behind the point of a decimal or whole-number column, None for other types."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    return 0 if isinstance(kind, T.IntegralType) else None


def _rate_scale(tables: SourceTables) -> int | None:
    """Scale of the effective rate; None if either rate column is not exact."""
    scales = (_scale(tables.orders, "currencyrate"), _scale(tables.currency_rates, "currencyrate"))
    return None if None in scales else max(scales)


def _amount_scale(tables: SourceTables) -> int | None:
    names = ("nettotalprice", "coupondiscountdistr")
    scales = [_scale(tables.order_items, name) for name in names]
    return None if None in scales else max(scales)


def _exact(tables: SourceTables) -> bool:
    return None not in (_rate_scale(tables), _amount_scale(tables))


def _rated_orders(tables: SourceTables, as_of: date) -> DataFrame:
    """Orders with their effective rate: the order's own, else the day's; 0 counts as none.

    The rate belongs to the order, so it is joined before the much larger line table. The
    statistics of the run decide how the join is done.
    """
    orders = orders_base(tables, as_of)
    rates = daily_rates(tables).filter(
        f"rate_date BETWEEN {day(lookback_start(as_of))} AND {day(as_of)}"
    )
    same_day = F.expr("currency_code = currencycode AND order_date = rate_date")
    scale = _rate_scale(tables) if _exact(tables) else None
    kind = "DOUBLE" if scale is None else f"DECIMAL({min(38, 12 + scale)},{scale})"
    rate = f"coalesce(CAST(order_currencyrate AS {kind}), CAST(currencyrate AS {kind}))"
    return orders.join(rates, same_day, "left").selectExpr(
        "order_id",
        "ordernumber",
        "shop",
        "order_date",
        f"nullif({rate}, CAST(0 AS {kind})) AS rate",
    )


def _item_lines(tables: SourceTables) -> DataFrame:
    """Product and shipping lines, narrowed to what the shuffle has to carry."""
    items = tables.order_items.filter(F.col("type").isin(PRODUCT, SHIPPING))
    scale = _amount_scale(tables) if _exact(tables) else None
    kind = "DOUBLE" if scale is None else f"DECIMAL({min(38, 16 + scale)},{scale})"
    return items.selectExpr(
        "orderid",
        "type",
        f"type = '{PRODUCT}' AS is_product",
        "CAST(round(coalesce(quantity, 0)) AS BIGINT) AS quantity",
        f"CAST(coalesce(nettotalprice, 0) AS {kind}) AS net_amount",
        f"CAST(abs(coalesce(coupondiscountdistr, 0)) AS {kind}) AS coupon_amount",
    )


def line_amounts(tables: SourceTables, as_of: date) -> DataFrame:
    """Order lines with net price, coupon and piece price in micro-euros.

    Decimal amounts and rates are divided exactly; if any of them is a double, all are.
    """
    orders, items = _rated_orders(tables, as_of), _item_lines(tables)
    # Both sides are fact tables: never broadcast one on a size estimate.
    lines = orders.join(items.hint("merge"), F.expr("order_id = orderid"))

    def in_euro(amount: str) -> str:
        if _exact(tables):
            return quotient_micros(amount, _amount_scale(tables), "rate", _rate_scale(tables))
        return micros(f"({amount} / rate)")

    amounts = lines.selectExpr(
        "order_id",
        "ordernumber",
        "shop",
        "order_date",
        "type",
        "is_product",
        "quantity",
        f"{in_euro('net_amount')} AS net",
        f"{in_euro('coupon_amount')} AS coupon",
    )
    price = f"CASE WHEN is_product AND quantity > 0 THEN {divide_half_up('net', 'quantity')} END"
    return amounts.selectExpr("*", f"{price} AS price")


def priced_lines(tables: SourceTables, as_of: date) -> DataFrame:
    """Product and shipping lines with net price and coupon amount in EUR."""
    return line_amounts(tables, as_of).selectExpr(
        "order_id",
        "ordernumber",
        "shop",
        "order_date",
        "type",
        "quantity",
        f"{as_money('net')} AS post_discount_net_eur",
        f"{as_money('coupon')} AS discount_amt_eur",
    )


def product_lines(tables: SourceTables, as_of: date) -> DataFrame:
    """Product lines with their price per piece (NULL without quantity or price)."""
    return line_amounts(tables, as_of).filter("is_product").selectExpr(
        "shop",
        "ordernumber",
        "quantity",
        f"{as_money('net')} AS net_amount_eur",
        f"{as_money('price')} AS unit_price_net_eur",
    )


PRICE_PARTS = ("price_sum_hi", "price_sum_lo", "price_n", "price_min", "price_max")
MERGED_PRICES = (
    *merge_sum("price_sum"),
    "sum(price_n) AS price_n",
    "min(price_min) AS price_min",
    "max(price_max) AS price_max",
)
STARTED_PRICES = (
    *start_sum("price", "price_sum"),
    "count(price) AS price_n",
    "min(price) AS price_min",
    "max(price) AS price_max",
)
ORDER_PRICES = (
    f"{as_money(mean_micros('price_sum', 'price_n'))} AS avg_unit_price_order_eur",
    f"{as_money('price_min')} AS min_unit_price_order_eur",
    f"{as_money('price_max')} AS max_unit_price_order_eur",
)


def unit_price_per_number(tables: SourceTables, as_of: date) -> DataFrame:
    """Mean, lowest and highest piece price per shop and order number."""
    lines = line_amounts(tables, as_of).filter("is_product")
    folded = lines.groupBy("shop", "ordernumber").agg(*sql_columns(*STARTED_PRICES))
    return folded.selectExpr("shop", "ordernumber", *ORDER_PRICES)


def order_totals(tables: SourceTables, as_of: date) -> DataFrame:
    """One row per order: started sums, product pieces, and mergeable piece-price parts.

    Grouping starts with the join key of the line join, so no further shuffle is needed.
    """
    lines = line_amounts(tables, as_of)
    return lines.groupBy("order_id", "shop", "ordernumber", "order_date").agg(
        *sql_columns(
            *start_sum("if(is_product, net, 0L)", "product_net"),
            *start_sum("if(is_product, 0L, net)", "shipping_net"),
            *start_sum("coalesce(net, 0L)", "revenue"),
            *start_sum("coalesce(coupon, 0L)", "coupon"),
            "sum(if(is_product, quantity, 0L)) AS pieces",
            *STARTED_PRICES,
        )
    )


def order_rows(tables: SourceTables, as_of: date) -> DataFrame:
    """Order totals with the refund flag; any refund row of the order counts."""
    totals = order_totals(tables, as_of)
    refunded = tables.refunds.selectExpr("orderid AS refunded_id").distinct()
    return totals.join(refunded, F.expr("order_id = refunded_id"), "left").selectExpr(
        *totals.columns, "if(refunded_id IS NULL, 0, 1) AS refunded_flag"
    )


def order_level(tables: SourceTables, as_of: date) -> DataFrame:
    """Order totals in EUR with refund flag and revenue."""
    return order_rows(tables, as_of).selectExpr(
        "shop",
        "order_id",
        "ordernumber",
        "order_date",
        f"{total('product_net')} AS product_net",
        f"{total('shipping_net')} AS shipping_net",
        f"{total('coupon')} AS discount_amt_eur",
        "pieces AS product_qty",
        "refunded_flag",
        f"{total('revenue')} AS revenue_net",
    )


_KEY_RANGE = 1 << 64
_UNTIMED = 10**18  # later than any time


def order_customer_map(tables: SourceTables) -> DataFrame:
    """The customer of the latest order interaction per order number.

    A missing event time counts as latest; equal times fall to the larger key. The
    maximum combines on the map side, so a hot order number shrinks before the shuffle. For
    whole-number keys, time and key are packed into one number, whose maximum needs no sort;
    other keys are compared as pairs.
    """
    seen = tables.interactions.filter(
        f"interaction_type = '{ORDER_INTERACTION}' AND related_ordernumber IS NOT NULL"
        " AND external_customerkey IS NOT NULL"
    )
    kinds = {f.name: f.dataType for f in tables.interactions.schema}
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    key_type = kinds["external_customerkey"]
    if isinstance(key_type, T.IntegralType) and isinstance(kinds["event_time"], times):
        moment = (
            f"coalesce(unix_micros(CAST(event_time AS TIMESTAMP)), {_UNTIMED}L)"
        )
        packed = (
            f"CAST(CAST({moment} AS DECIMAL(19,0)) * {_KEY_RANGE}"
            f" + (external_customerkey + {_KEY_RANGE // 2}) AS DECIMAL(38,0))"
        )
        latest = seen.groupBy(F.col("related_ordernumber").alias("ordernumber")).agg(
            F.expr(f"max({packed})").alias("latest")
        )
        key = f"pmod(latest, CAST({_KEY_RANGE} AS DECIMAL(38,0))) - {_KEY_RANGE // 2}"
        return latest.selectExpr(
            "ordernumber", f"CAST({key} AS {key_type.simpleString()}) AS {ID_COLUMN}"
        )
    latest = seen.selectExpr(
        "related_ordernumber AS ordernumber",
        "struct(event_time IS NULL AS untimed, event_time, external_customerkey) AS visit",
    ).groupBy("ordernumber").agg(F.expr("max(visit) AS latest"))
    return latest.selectExpr("ordernumber", f"latest.external_customerkey AS {ID_COLUMN}")


def number_totals(rows: DataFrame, as_of: date) -> DataFrame:
    """Fold order rows to one row per shop and order number.

    The customer depends on the order number alone, so this is also the distinct-count
    grain per customer and shop. Folding before the customer is joined keeps the join free
    of hot order numbers. A number lies in a window exactly if its last day does, so one
    date replaces a flag per window.
    """

    def inside(window: str) -> str:
        return since("order_date", as_of, window)

    folded = rows.groupBy("shop", "ordernumber").agg(
        *sql_columns(
            "min(order_date) AS first_day",
            "max(order_date) AS last_day",
            "max(order_date) FILTER (WHERE refunded_flag = 1) AS last_refunded_day",
            *merge_sum("revenue", "revenue_lifetime"),
            *(c for w in REVENUE_WINDOWS for c in merge_sum("revenue", f"revenue_{w}", inside(w))),
            "sum(pieces) AS pieces_lifetime",
            *(f"sum(pieces) FILTER (WHERE {inside(w)}) AS pieces_{w}" for w in PIECE_WINDOWS),
            f"sum(if({is_positive('coupon')}, pieces, 0L)) AS pieces_couponed",
            *merge_sum("coupon"),
            f"max(if({is_positive('coupon')}, {total('coupon')}, 0)) AS coupon_max",
            "count(1) AS order_rows",
            *MERGED_PRICES,
        )
    )
    # Piece prices are looked up by shop, so rows without a shop have none.
    return folded.selectExpr(
        *(c for c in folded.columns if c not in PRICE_PARTS),
        f"if(shop IS NULL, NULL, {mean_micros('price_sum', 'price_n')}) AS price_mean",
        "if(shop IS NULL, NULL, price_min) AS price_min",
        "if(shop IS NULL, NULL, price_max) AS price_max",
    )


def orders_mapped(tables: SourceTables, as_of: date) -> DataFrame:
    """Order rows with their customer and the piece prices of their order number.

    Rows of one number are spread over salts of the order id; the lookup side repeats a
    number only for the salts that really occur, so a hot number is split and a
    normal one is not multiplied.
    """
    # Written once: rows and price lookup would each plan the join of all lines otherwise.
    rows = stage(
        order_rows(tables, as_of).selectExpr("*", f"pmod(hash(order_id), {SALTS}) AS salt"),
        "order-rows",
    )
    prices = rows.groupBy("shop", "ordernumber").agg(
        *sql_columns("collect_set(salt) AS salts", *MERGED_PRICES)
    )
    names = [e.rsplit(" AS ", 1)[1] for e in ORDER_PRICES]
    lookup = (
        prices.selectExpr("shop", "ordernumber", "salts", *ORDER_PRICES)
        .join(order_customer_map(tables), "ordernumber")
        .selectExpr(
            ID_COLUMN,
            "shop AS lookup_shop",
            "ordernumber AS lookup_number",
            *(f"if(shop IS NULL, NULL, {name}) AS {name}" for name in names),
            "explode(salts) AS lookup_salt",
        )
    )
    same = "ordernumber = lookup_number AND salt = lookup_salt AND shop <=> lookup_shop"
    return rows.join(lookup, F.expr(same)).selectExpr(
        ID_COLUMN,
        "shop",
        "ordernumber",
        "order_date",
        f"{total('revenue')} AS revenue_net",
        "pieces AS product_qty",
        f"{total('coupon')} AS discount_amt_eur",
        "refunded_flag",
        *names,
    )
