"""The expected results as DuckDB SQL, written in the direct form.

Distinct counts are real distinct counts, means run over rows, ranks are real ranks: the
SQL shares no shortcut with the Spark jobs it checks.
"""

from __future__ import annotations

from promolens.config import (
    FEATURE_FIELDS,
    LEAKAGE_COLUMNS,
    SEGMENT_LABELS,
    TARGET_COLUMN,
    WINDOW_TOKENS,
    ZERO_FILLED_COLUMN,
)
from testkit import boost_sql, checks
from testkit.fixed_model import importance_sql, score_sql
from testkit.views import AS_OF, VIEW_SQL, duckdb_view

MIN_SHARE = 0.04
SEED = 42
DAY = f"DATE '{AS_OF}'"
START = f"CAST({DAY} - INTERVAL 60 MONTH AS DATE)"
LOOKBACKS = {"15d": "15 DAY", "30d": "30 DAY", "3m": "3 MONTH", "6m": "6 MONTH", "12m": "12 MONTH"}
SINCE = {w: f"CAST({DAY} - INTERVAL {span} AS DATE)" for w, span in LOOKBACKS.items()}
FEATURES = [name for name, _ in FEATURE_FIELDS]
NOT_FEATURES = {
    "externalcustomerkey", "as_of_date", "first_order_date", "last_order_date", "country",
    "gender", "shops_included", "registration_flag", "account_age_days", *LEAKAGE_COLUMNS,
}
NUMERIC_FEATURES = [c for c in FEATURES if c not in NOT_FEATURES]


def half_up(total: str, n: str, scale: int) -> str:
    """total / n rounded half up to ``scale`` digits, in integers (no float step)."""
    unit = "0." + "0" * (scale - 1) + "1"
    return (
        f"CASE WHEN {n} > 0 THEN CAST((2 * CAST({total} * {10**scale} AS HUGEINT)"
        f" + CAST({n} AS HUGEINT)) // (2 * CAST({n} AS HUGEINT)) AS DECIMAL(24,0))"
        f" * CAST({unit} AS DECIMAL({scale + 1},{scale})) END"
    )


def dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def big(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def quotient(a: str, b: str, name: str) -> str:
    return f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END AS {name}"


def listed(*items: str) -> str:
    return ",\n  ".join(items)


def distinct_numbers(name: str, condition: str = "TRUE") -> str:
    return big(f"count(DISTINCT ordernumber) FILTER (WHERE {condition})", name)


CTES: dict[str, str] = {f"src_{name}": duckdb_view(name) for name in VIEW_SQL}

CTES["kept_orders"] = f"""
SELECT id AS order_id, ordernumber, shop, CAST(created_date AS DATE) AS order_date,
       currency_code, currencyrate AS order_currencyrate
FROM src_orders
WHERE trim(testorder) = '0' AND state IN ('ARCHIVED', 'EXPORTED')
  AND CAST(created_date AS DATE) >= {START} AND CAST(created_date AS DATE) <= {DAY}"""


def in_euro(amount: str) -> str:
    """amount / rate rounded half up to micro-euros, in whole numbers (no float step).

    Amounts have four digits behind the point and rates four, so 10**6 remains as the factor.
    """
    return (
        f"CASE WHEN rate <> 0 THEN CAST(CASE WHEN {amount} < 0 THEN -1 ELSE 1 END"
        f" * ((2 * CAST(abs({amount}) * 10000 AS HUGEINT) * 1000000"
        f" + CAST(rate * 10000 AS HUGEINT)) // (2 * CAST(rate * 10000 AS HUGEINT)))"
        f" AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) END"
    )


CTES["rated"] = """
SELECT k.order_id, k.ordernumber, k.shop, k.order_date, i.type,
       CAST(round(coalesce(i.quantity, 0)) AS BIGINT) AS quantity,
       coalesce(i.nettotalprice, 0) AS amount,
       abs(coalesce(i.coupondiscountdistr, 0)) AS cut,
       coalesce(k.order_currencyrate, r.currencyrate) AS rate
FROM kept_orders k
JOIN src_order_items i ON i.orderid = k.order_id AND i.type IN ('PRODUCT', 'SHIPPING')
LEFT JOIN src_currency_rates r ON r.currencycode = k.currency_code AND r.date = k.order_date"""

CTES["lines"] = f"""
SELECT order_id, ordernumber, shop, order_date, type, quantity,
       CAST({in_euro("amount")} AS DECIMAL(18,6)) AS net,
       CAST({in_euro("cut")} AS DECIMAL(18,6)) AS coupon
FROM rated"""

CTES["pieces"] = f"""
SELECT shop, ordernumber, quantity, net,
       CASE WHEN net IS NOT NULL THEN {half_up("net", "quantity", 6)} END AS price
FROM lines WHERE type = 'PRODUCT'"""

CTES["number_prices"] = f"""
SELECT shop, ordernumber, {half_up("sum(price)", "count(price)", 6)} AS price_mean,
       min(price) AS price_min, max(price) AS price_max
FROM pieces GROUP BY shop, ordernumber"""

CTES["per_order"] = """
SELECT shop, order_id, ordernumber, order_date,
       sum(CASE WHEN type = 'PRODUCT' THEN net ELSE 0 END) AS product_net,
       sum(CASE WHEN type = 'SHIPPING' THEN net ELSE 0 END) AS shipping_net,
       sum(coalesce(coupon, 0)) AS coupon,
       sum(CASE WHEN type = 'PRODUCT' THEN quantity ELSE 0 END) AS pieces
FROM lines GROUP BY shop, order_id, ordernumber, order_date"""

CTES["flagged"] = """
SELECT o.*, coalesce(product_net, 0) + coalesce(shipping_net, 0) AS revenue,
       CASE WHEN order_id IN (SELECT orderid FROM src_refunds) THEN 1 ELSE 0 END AS refunded
FROM per_order o"""

CTES["buyer"] = """
SELECT related_ordernumber AS ordernumber, external_customerkey AS externalcustomerkey
FROM src_interactions
WHERE interaction_type = 'order' AND related_ordernumber IS NOT NULL
  AND external_customerkey IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY related_ordernumber
                           ORDER BY event_time DESC NULLS FIRST) = 1"""

CTES["bought"] = """
SELECT b.externalcustomerkey, f.shop, f.ordernumber, f.order_date, f.revenue, f.pieces,
       f.coupon, f.refunded, p.price_mean, p.price_min, p.price_max
FROM flagged f JOIN buyer b USING (ordernumber)
LEFT JOIN number_prices p ON p.shop = f.shop AND p.ordernumber = f.ordernumber"""


def _window_sums(value: str, prefix: str, windows) -> list[str]:
    return [
        f"sum({value}) FILTER (WHERE order_date >= {SINCE[w]}) AS {prefix}_{w}" for w in windows
    ]


CTES["at_shop"] = f"""
SELECT {listed(
    "externalcustomerkey", "shop",
    "min(order_date) AS first_order_date", "max(order_date) AS last_order_date",
    distinct_numbers("orders_lifetime"),
    *(distinct_numbers(f"orders_{w}", f"order_date >= {SINCE[w]}") for w in LOOKBACKS),
    "sum(revenue) AS revenue_lifetime",
    *_window_sums("revenue", "revenue", ("15d", "30d", "6m", "12m")),
    "sum(pieces) AS items_qty_lifetime", *_window_sums("pieces", "items_qty", ("6m", "12m")),
    "sum(coupon) AS discount_abs_lifetime",
    distinct_numbers("discounted_orders", "coupon > 0"),
    "max(coupon) AS max_discount_single_order",
    distinct_numbers("refund_orders_lifetime", "refunded = 1"),
    *(
        distinct_numbers(f"refund_orders_{w}", f"refunded = 1 AND order_date >= {SINCE[w]}")
        for w in ("3m", "6m", "12m")
    ),
    half_up("sum(price_mean)", "count(price_mean)", 6) + " AS avg_unit_price_lifetime_eur",
    "min(price_min) AS min_unit_price_lifetime_eur",
    "max(price_max) AS max_unit_price_lifetime_eur",
    half_up("sum(CASE WHEN coupon > 0 THEN pieces ELSE 0 END)", "sum(pieces)", 9)
    + " AS share_of_items_discounted",
)}
FROM bought GROUP BY externalcustomerkey, shop"""

SUMMED = [
    "orders_lifetime", *(f"orders_{w}" for w in LOOKBACKS),
    "items_qty_lifetime", "items_qty_6m", "items_qty_12m",
    *(f"refund_orders_{w}" for w in ("lifetime", "3m", "6m", "12m")),
]
REVENUE = ("lifetime", "15d", "30d", "6m", "12m")

CTES["person"] = f"""
SELECT {listed(
    "externalcustomerkey",
    "min(first_order_date) AS first_order_date", "max(last_order_date) AS last_order_date",
    *(big(f"sum({c})", c) for c in SUMMED),
    *(f"sum(revenue_{w}) AS revenue_net_{w}_eur" for w in REVENUE),
    "sum(discount_abs_lifetime) AS discount_abs_lifetime_eur",
    big("sum(discounted_orders)", "discounted_orders_lifetime"),
    "max(max_discount_single_order) AS max_discount_single_order",
    half_up("sum(avg_unit_price_lifetime_eur)", "count(avg_unit_price_lifetime_eur)", 6)
    + " AS avg_unit_price_lifetime_eur",
    "min(min_unit_price_lifetime_eur) AS min_unit_price_lifetime_eur",
    "max(max_unit_price_lifetime_eur) AS max_unit_price_lifetime_eur",
    "count(DISTINCT shop) AS shops_included",
    half_up("sum(share_of_items_discounted)", "count(share_of_items_discounted)", 9)
    + " AS share_of_items_discounted",
)}
FROM at_shop GROUP BY externalcustomerkey"""

CTES["traits"] = """
SELECT externalcustomerkey, max(country) AS country,
       max(CASE WHEN gender IS NULL OR gender = '' THEN 'Undefined' ELSE gender END) AS gender
FROM src_customers WHERE externalcustomerkey IS NOT NULL GROUP BY externalcustomerkey"""

DOUBLES = [
    *(f"revenue_net_{w}_eur" for w in REVENUE), "discount_abs_lifetime_eur",
    "max_discount_single_order", "avg_unit_price_lifetime_eur", "min_unit_price_lifetime_eur",
    "max_unit_price_lifetime_eur", "share_of_items_discounted",
]
GROSS = "(revenue_net_lifetime_eur + discount_abs_lifetime_eur)"
CTES["features"] = f"""
SELECT {listed(
    "p.externalcustomerkey", f"{DAY} AS as_of_date", "shops_included", "first_order_date",
    "last_order_date",
    f"CAST(date_diff('day', last_order_date, {DAY}) AS INTEGER) AS days_since_last_order",
    *SUMMED,
    *(dbl(c, c) for c in DOUBLES),
    *(
        quotient(f"revenue_net_{w}_eur", f"orders_{w}", f"aov_net_{w}_eur")
        for w in ("lifetime", "12m", "6m")
    ),
    *(
        quotient(f"items_qty_{w}", f"orders_{w}", f"avg_items_per_order_{w}")
        for w in ("lifetime", "12m", "6m")
    ),
    quotient("discount_abs_lifetime_eur", GROSS, "discount_rate_lifetime"),
    quotient("discounted_orders_lifetime", "orders_lifetime", "share_of_orders_with_discount"),
    quotient("discount_abs_lifetime_eur", "discounted_orders_lifetime", "avg_discount_per_order"),
    *(
        quotient(f"refund_orders_{w}", f"orders_{w}", f"refund_rate_{w}")
        for w in ("lifetime", "12m", "6m", "3m")
    ),
    "CAST(NULL AS INTEGER) AS account_age_days", "CAST(0 AS SMALLINT) AS registration_flag",
    "country", "gender",
)}
FROM person p LEFT JOIN traits t ON t.externalcustomerkey = p.externalcustomerkey"""

WINDOWED = [
    c for c in FEATURES if any(t in c for t in WINDOW_TOKENS) or c == ZERO_FILLED_COLUMN
]
CTES["filled"] = "SELECT * REPLACE ({}) FROM features".format(
    ", ".join(f"coalesce({c}, 0) AS {c}" for c in WINDOWED)
)
CTES["labelled"] = f"""
SELECT *, CASE WHEN share_of_orders_with_discount > 0 OR discount_abs_lifetime_eur > 0
               THEN 1 ELSE 0 END AS {TARGET_COLUMN}
FROM filled"""
CTES["shares"] = """
SELECT country, count(*) AS row_count,
       CAST(count(*) AS DOUBLE)
           / (SELECT count(*) FROM features WHERE country IS NOT NULL) AS share
FROM features WHERE country IS NOT NULL GROUP BY country"""
CTES["majors"] = f"SELECT country, row_count FROM shares WHERE share >= {MIN_SHARE}"
CTES["placed"] = """
SELECT l.*, CASE WHEN country IN (SELECT country FROM majors) THEN country
                 ELSE 'OTHER' END AS place
FROM labelled l"""
CTES["flags"] = "SELECT DISTINCT place FROM placed"
CTES["ready"] = "SELECT * FROM placed WHERE {}".format(
    " AND ".join(f"{c} IS NOT NULL" for c in NUMERIC_FEATURES)
)
CTES["hashed"] = f"""
SELECT externalcustomerkey, {TARGET_COLUMN} AS label,
       CAST('0x' || substr(md5(externalcustomerkey || '|{SEED}'), 1, 15) AS BIGINT) AS h
FROM ready"""
CTES["class_sizes"] = """
SELECT label, count(*) AS n, ceil(0.2 * (SELECT count(*) FROM ready)) * count(*)
       / (SELECT count(*) FROM ready) AS exact
FROM hashed GROUP BY label"""
CTES["class_cuts"] = """
SELECT label, floor(exact) + CASE WHEN row_number() OVER (
           ORDER BY exact - floor(exact) DESC, label)
       <= sum(exact) OVER () - sum(floor(exact)) OVER () + 1e-9 THEN 1 ELSE 0 END AS held
FROM class_sizes"""
CTES["split_rows"] = f"""
SELECT x.externalcustomerkey, x.label AS {TARGET_COLUMN},
       CASE WHEN row_number() OVER (PARTITION BY x.label ORDER BY x.h) <= c.held
            THEN 1 ELSE 0 END AS is_validation
FROM hashed x JOIN class_cuts c ON c.label = x.label"""
CTES |= boost_sql.ctes(NUMERIC_FEATURES, SEED)
LOW, MIDDLE, HIGH = SEGMENT_LABELS
CTES["proxy"] = f"""
SELECT externalcustomerkey, share_of_items_discounted AS score,
       CASE WHEN share_of_items_discounted BETWEEN 0 AND 0.2 THEN '{LOW}'
            WHEN share_of_items_discounted > 0.2 AND share_of_items_discounted <= 0.5
                 THEN '{MIDDLE}'
            WHEN share_of_items_discounted > 0.5 AND share_of_items_discounted <= 1
                 THEN '{HIGH}' END AS segment
FROM features"""
CTES["dirty_dates"] = """
SELECT externalcustomerkey,
       CASE WHEN externalcustomerkey % 7 = 0 THEN 'unknown'
            WHEN externalcustomerkey % 11 = 0 THEN '2001-02-30'
            WHEN externalcustomerkey % 13 = 0 THEN NULL
            ELSE CAST(first_order_date AS VARCHAR) END AS first_order_date,
       CAST(last_order_date AS VARCHAR) AS last_order_date,
       CASE WHEN externalcustomerkey % 5 = 0 THEN '30.06.2001'
            ELSE CAST(as_of_date AS VARCHAR) END AS as_of_date
FROM features"""

# What _local_dates of the registry writes and one format a column can read of it.
CTES["local_dates"] = """
SELECT externalcustomerkey,
       CASE WHEN externalcustomerkey % 7 = 0 OR externalcustomerkey % 11 = 0
                 OR externalcustomerkey % 13 = 0 OR externalcustomerkey % 17 = 0
            THEN NULL ELSE first_order_date END AS first_order_date,
       CASE WHEN externalcustomerkey % 5 = 0 THEN NULL ELSE last_order_date END
            AS last_order_date,
       as_of_date,
       externalcustomerkey % 7 = 0 OR externalcustomerkey % 11 = 0
       OR (externalcustomerkey % 13 <> 0 AND externalcustomerkey % 17 = 0
           AND first_order_date IS NOT NULL) AS odd_first
FROM features"""
LOCAL_DATES = (
    "SELECT externalcustomerkey, as_of_date, first_order_date, last_order_date FROM local_dates"
)

NUMERIC_LIST = ", ".join(NUMERIC_FEATURES)
FEATURE_LIST = ", ".join(FEATURES)
SPARK_TYPES = {name: kind for name, kind in FEATURE_FIELDS}


def with_ctes(select: str) -> str:
    """Prefix the CTEs a statement needs, in order of definition."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        text = pending.pop()
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").split())
        for name in CTES:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(CTES[name])
    prefix = ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed)
    return f"WITH {prefix}\n{select}" if prefix else select


def _scored_pairs() -> str:
    return f"""
SELECT CAST(half_wins AS DOUBLE) / (2 * (CAST(p AS DOUBLE) * CAST(n AS DOUBLE))) AS auc,
       p AS positives, n AS negatives
FROM (SELECT sum(2 * r + t - 1) FILTER (WHERE y = 1)
             - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) AS half_wins,
             count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y = 0) AS n
      FROM (SELECT {TARGET_COLUMN} AS y, rank() OVER (ORDER BY items_qty_lifetime) AS r,
                   count(*) OVER (PARTITION BY items_qty_lifetime) AS t
            FROM labelled) ranked) counted"""


def _profile() -> str:
    rows = [
        f"SELECT {i} AS position, '{c}' AS column_name, '{SPARK_TYPES[c]}' AS data_type,"
        f" count(*) AS row_count, count({c}) AS filled_count FROM features"
        for i, c in enumerate(FEATURES)
    ]
    return " UNION ALL ".join(rows)


def _date_summary() -> str:
    def one(c: str) -> str:
        day = f"date_diff('day', DATE '1970-01-01', {c})"
        quart = [
            f"quantile_cont({day}, {q}) AS {n}_day"
            for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
        return (
            f"SELECT '{c}' AS column_name, count({c}) AS filled_count, avg({day}) AS mean_day,"
            f" min({c}) AS first_date, {', '.join(quart)}, max({c}) AS last_date FROM features"
        )

    return " UNION ALL ".join(one(c) for c in ("as_of_date", "first_order_date", "last_order_date"))


def _parse_failures() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NULL)"
        f" AS missing_count, count(*) FILTER (WHERE TRY_CAST({c} AS DATE) IS NULL"
        f" AND {c} IS NOT NULL) AS unparsed_count FROM dirty_dates"
        for c in ("as_of_date", "first_order_date", "last_order_date")
    )


def _constants(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN count(DISTINCT {c})"
        f" + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1 THEN 1 ELSE 0 END AS is_constant,"
        f" count(*) - count({c}) AS missing_count FROM features"
        for c in columns
    )


def _metadata() -> str:
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(NUMERIC_FEATURES))
    return f"""
SELECT 'country_min_share' AS key, 0 AS position, '{MIN_SHARE}' AS value
UNION ALL
SELECT 'major_countries',
       CAST(row_number() OVER (ORDER BY row_count DESC, country) - 1 AS INTEGER), country
FROM majors
UNION ALL
SELECT 'feature_columns', i, c FROM (VALUES {names}) AS v(i, c)
UNION ALL
SELECT 'feature_columns',
       CAST({len(NUMERIC_FEATURES) - 1} + row_number() OVER (ORDER BY place) AS INTEGER),
       'country_' || place
FROM flags
UNION ALL
SELECT 'target_column', 0, '{TARGET_COLUMN}'
UNION ALL
SELECT 'notes', 0, 'written by the preparation step; reuse it unchanged for scoring'"""


PREPARED = (
    f"SELECT externalcustomerkey, {NUMERIC_LIST}, {TARGET_COLUMN},"
    " 'country_' || place AS country_flag FROM ready"
)
ZEROED = ", ".join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC_FEATURES)
ALIGNED = [c for c in NUMERIC_FEATURES if c not in ("orders_15d", "aov_net_lifetime_eur")]
FEATURE_TABLE = f"SELECT {FEATURE_LIST} FROM features"
SEGMENTED = "SELECT externalcustomerkey, score, segment FROM proxy"
MONEY_AT_SHOP = [
    *(f"revenue_{w}" for w in REVENUE), "discount_abs_lifetime", "max_discount_single_order",
    "avg_unit_price_lifetime_eur", "min_unit_price_lifetime_eur", "max_unit_price_lifetime_eur",
]
COUNTS_AT_SHOP = ["first_order_date", "last_order_date"]

SELECTS: dict[str, str] = {
    "scan_orders": "SELECT * REPLACE (CAST(created_date AS DATE) AS created_date,"
    " CAST(currencyrate AS DOUBLE) AS currencyrate) FROM src_orders",
    "scan_orderitems": "SELECT * REPLACE (CAST(nettotalprice AS DOUBLE) AS nettotalprice,"
    " CAST(coupondiscountdistr AS DOUBLE) AS coupondiscountdistr) FROM src_order_items",
    "scan_refunds": "SELECT * FROM src_refunds",
    "scan_currencyrates": "SELECT * REPLACE (CAST(currencyrate AS DOUBLE) AS currencyrate)"
    " FROM src_currency_rates",
    "scan_interactions": "SELECT * REPLACE (CAST(event_time AS VARCHAR) AS event_time)"
    " FROM src_interactions",
    "scan_customers": "SELECT * FROM src_customers",
    "params": " UNION ALL ".join(
        f"SELECT '{w}' AS window_name, {DAY} AS as_of_date, {d} AS start_date,"
        f" count(*) FILTER (WHERE order_date >= {d}) AS orders_in_window FROM kept_orders"
        for w, d in {"lifetime": START, **SINCE}.items()
    ),
    "fx_rates_dup_check": """
SELECT currencycode, CAST(sum(n) AS BIGINT) AS rates, count(*) AS days,
       count(*) FILTER (WHERE n > 1) AS duplicated_days
FROM (SELECT currencycode, date, count(*) AS n FROM src_currency_rates GROUP BY ALL) d
GROUP BY currencycode""",
    "orders_base": "SELECT * REPLACE (CAST(order_currencyrate AS DOUBLE) AS order_currencyrate)"
    " FROM kept_orders",
    "orderitems_net": f"""
SELECT order_id, ordernumber, shop, order_date, type, quantity,
       {dbl("net", "post_discount_net_eur")}, {dbl("coupon", "discount_amt_eur")} FROM lines""",
    "product_lines": f"""
SELECT shop, ordernumber, quantity, {dbl("net", "net_amount_eur")},
       {dbl("price", "unit_price_net_eur")} FROM pieces""",
    "unit_price_order": f"""
SELECT shop, ordernumber, {dbl("price_mean", "avg_unit_price_order_eur")},
       {dbl("price_min", "min_unit_price_order_eur")},
       {dbl("price_max", "max_unit_price_order_eur")} FROM number_prices""",
    "order_level": f"""
SELECT shop, order_id, ordernumber, order_date, {dbl("product_net", "product_net")},
       {dbl("shipping_net", "shipping_net")}, {dbl("coupon", "discount_amt_eur")},
       {big("pieces", "product_qty")}, refunded AS refunded_flag, {dbl("revenue", "revenue_net")}
FROM flagged""",
    "cif_order_map": "SELECT ordernumber, externalcustomerkey FROM buyer",
    "orders_mapped": f"""
SELECT externalcustomerkey, shop, ordernumber, order_date, {dbl("revenue", "revenue_net")},
       {big("pieces", "product_qty")}, {dbl("coupon", "discount_amt_eur")},
       refunded AS refunded_flag, {dbl("price_mean", "avg_unit_price_order_eur")},
       {dbl("price_min", "min_unit_price_order_eur")},
       {dbl("price_max", "max_unit_price_order_eur")} FROM bought""",
    "cust_shop": "SELECT externalcustomerkey, shop, {} FROM at_shop".format(
        listed(
            *COUNTS_AT_SHOP,
            *(big(c, c) for c in SUMMED),
            "discounted_orders",
            *(dbl(c, c) for c in MONEY_AT_SHOP),
            dbl("share_of_items_discounted", "share_of_items_discounted"),
        )
    ),
    "items_discount_share": "SELECT externalcustomerkey, shop, {} FROM at_shop".format(
        dbl("share_of_items_discounted", "share_of_items_discounted")
    ),
    "customer_rollup": "SELECT * REPLACE ({}) FROM person".format(
        ", ".join(dbl(c, c) for c in DOUBLES)
    ),
    "items_discount_share_cust": "SELECT externalcustomerkey, {} FROM person".format(
        dbl("share_of_items_discounted", "share_of_items_discounted")
    ),
    "cust_attrs": "SELECT * FROM traits",
    "feature_table": FEATURE_TABLE,
    "feature_table_write": FEATURE_TABLE,
    "feature_table_bucketed": FEATURE_TABLE,
    "csv_round_trip": FEATURE_TABLE,
    "table_profile": _profile(),
    "coerce_dates": "SELECT externalcustomerkey, {} FROM dirty_dates".format(
        ", ".join(
            f"TRY_CAST({c} AS DATE) AS {c}"
            for c in ("as_of_date", "first_order_date", "last_order_date")
        )
    ),
    "date_parse_failures": _parse_failures(),
    "coerce_dates_inferred": LOCAL_DATES,
    "inferred_dates_csv": LOCAL_DATES,
    "date_failures_inferred": """
SELECT 'as_of_date' AS column_name, count(*) - count(as_of_date) AS missing_count,
       0 AS unparsed_count FROM local_dates
UNION ALL
SELECT 'first_order_date', count(*) - count(first_order_date),
       count(*) FILTER (WHERE odd_first) FROM local_dates
UNION ALL
SELECT 'last_order_date', count(*) - count(last_order_date),
       count(*) FILTER (WHERE externalcustomerkey % 5 = 0) FROM local_dates""",
    "date_summary": _date_summary(),
    "impossible_dates": """
SELECT count(*) FILTER (WHERE first_order_date > DATE '2000-12-31'
                        OR last_order_date > DATE '2000-12-31') AS impossible_rows,
       count(*) AS all_rows FROM features""",
    "fill_report": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS filled_with_zero"
        " FROM features"
        for c in WINDOWED
    ),
    "drop_all_null": f"SELECT {', '.join(c for c in FEATURES if c != 'account_age_days')}"
    " FROM features",
    "fill_window_zero": f"SELECT {FEATURE_LIST} FROM filled",
    "train_counts": f"""
SELECT CAST(count(*) FILTER (is_validation = 0) AS DOUBLE) AS n_train,
       CAST(count(*) FILTER (is_validation = 1) AS DOUBLE) AS n_val,
       avg({TARGET_COLUMN}) FILTER (is_validation = 0) AS pos_rate_train,
       avg({TARGET_COLUMN}) FILTER (is_validation = 1) AS pos_rate_val,
       CAST({len(NUMERIC_FEATURES)} + (SELECT count(*) FROM flags) AS DOUBLE) AS feature_count
FROM split_rows""",
    "feature_importance_names": "SELECT unnest([{}]) AS feature, TRUE AS consistent"
    " UNION ALL SELECT 'country', TRUE FROM flags".format(
        ", ".join(f"'{c}'" for c in NUMERIC_FEATURES)
    ),
    "fixed_model_scores": f"SELECT externalcustomerkey, {score_sql()} AS score"
    f" FROM (SELECT externalcustomerkey, {ZEROED} FROM placed)",
    "fixed_model_importance": importance_sql(NUMERIC_FEATURES),
    "score_preview": f"SELECT externalcustomerkey, {score_sql()} AS score"
    f" FROM (SELECT externalcustomerkey, {ZEROED} FROM placed) z"
    " ORDER BY externalcustomerkey LIMIT 5",
    "argument_checks": checks.SQL,
    "score_rows": "SELECT externalcustomerkey, TRUE AS is_probability FROM features",
    "segment_totals": "SELECT count(*) AS customers, CAST(1 AS DOUBLE) AS share FROM features",
    "split_missing_key": "SELECT count(*) AS all_rows, count(*) AS placed_rows FROM ready",
    "make_target_nan": f"""
SELECT externalcustomerkey, CASE WHEN externalcustomerkey % 2 <> 0
       AND share_of_orders_with_discount > 0 THEN 1 ELSE 0 END AS {TARGET_COLUMN}
FROM features""",
    "drop_all_nan": "SELECT unnest([{}]) AS column_name".format(
        ", ".join(
            f"'{c}'" for c in FEATURES if c not in ("account_age_days", "aov_net_lifetime_eur")
        )
    ),
    "csv_text_key": "SELECT * REPLACE ('C-' || CAST(externalcustomerkey AS VARCHAR)"
    f" AS externalcustomerkey) FROM ({FEATURE_TABLE})",
    "make_target": f"SELECT externalcustomerkey, {TARGET_COLUMN} FROM labelled",
    "target_distribution": f"""
SELECT {TARGET_COLUMN}, count(*) AS row_count,
       CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM labelled) AS share
FROM labelled GROUP BY {TARGET_COLUMN}""",
    "country_share": "SELECT country, row_count, share FROM shares",
    "country_onehot": """
SELECT externalcustomerkey, 'country_' || f.place AS flag,
       CASE WHEN p.place = f.place THEN 1 ELSE 0 END AS value
FROM placed p, flags f""",
    "constant_columns": _constants(
        ("gender", "shops_included", "registration_flag", "account_age_days", "country")
    ),
    "prepared": PREPARED,
    "prepared_round_trip": PREPARED,
    "prep_metadata": _metadata(),
    "dropped_rows": "SELECT count(*) - (SELECT count(*) FROM ready) AS incomplete_rows"
    " FROM placed",
    "stratified_split": f"SELECT externalcustomerkey, {TARGET_COLUMN}, is_validation"
    " FROM split_rows",
    "stratified_split_approx": f"""
SELECT externalcustomerkey, label AS {TARGET_COLUMN},
       CASE WHEN h < {(1 << 60) // 5} THEN 1 ELSE 0 END AS is_validation FROM hashed""",
    "split_balance": f"""
SELECT is_validation, count(*) AS row_count, {big(f"sum({TARGET_COLUMN})", "positives")},
       avg({TARGET_COLUMN}) AS positive_rate
FROM split_rows GROUP BY is_validation""",
    "roc_auc": _scored_pairs(),
    "bucketize": SEGMENTED,
    "segments_csv": SEGMENTED,
    "segment_distribution": """
SELECT s.segment, count(p.externalcustomerkey) AS row_count,
       CAST(count(p.externalcustomerkey) AS DOUBLE) / (SELECT count(*) FROM proxy) AS share
FROM (VALUES {}) AS s(segment) LEFT JOIN proxy p ON p.segment = s.segment
GROUP BY s.segment
UNION ALL
SELECT NULL, count(*), CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM proxy)
FROM proxy WHERE segment IS NULL HAVING count(*) > 0""".format(
        ", ".join(f"('{label}')" for label in SEGMENT_LABELS)
    ),
    "resumed_run": """
SELECT a.attempt, s.step,
       a.attempt = 2 OR (a.attempt = 3 AND s.step NOT LIKE 'segments%') AS reused,
       (SELECT count(*) FROM features) AS customers
FROM (VALUES (1), (2), (3)) AS a(attempt),
     (VALUES ('train'), ('importance'), ('scores'), ('scores_csv'), ('segments'),
             ('segments_csv')) AS s(step)""",
    "scoring_frame": f"""
SELECT externalcustomerkey, {ZEROED}, 'country_' || place AS country_flag FROM placed""",
    "align_features": f"""
SELECT externalcustomerkey, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ALIGNED)},
       CAST(0 AS BIGINT) AS orders_15d, 0 AS aov_net_lifetime_eur,
       CASE WHEN externalcustomerkey % 9 = 0 THEN 'country_OTHER'
            ELSE 'country_' || place END AS country_flag
FROM placed""",
}


SELECTS |= boost_sql.SELECTS


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(select) for name, select in SELECTS.items()}
