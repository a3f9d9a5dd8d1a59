"""Hand-made source tables: every test states only the rows it needs."""

from __future__ import annotations

from datetime import date, datetime

from promolens.sources.tables import SourceTables

AS_OF = date(2024, 3, 31)

SCHEMAS = {
    "orders": "id bigint, ordernumber string, shop string, created_date date,"
    " currency_code string, currencyrate double, testorder string, state string",
    "order_items": "orderid bigint, type string, quantity double, nettotalprice double,"
    " coupondiscountdistr double",
    "refunds": "orderid bigint",
    "currency_rates": "currencycode string, date date, currencyrate double",
    "interactions": "interaction_type string, related_ordernumber string,"
    " external_customerkey bigint, event_time timestamp",
    "customers": "externalcustomerkey bigint, country string, gender string",
}


def order(id, number=None, shop="A", day=date(2024, 3, 1), currency="EUR", rate=1.0, test="0",
          state="EXPORTED"):
    return (id, number or f"N{id}", shop, day, currency, rate, test, state)


def item(orderid, net=10.0, quantity=1.0, coupon=None, type="PRODUCT"):
    return (orderid, type, *(None if x is None else float(x) for x in (quantity, net, coupon)))


def bought_by(customer, number, when=datetime(2024, 3, 1), kind="order"):
    return (kind, number, customer, when)


def tables(spark, **rows) -> SourceTables:
    return SourceTables(
        **{name: spark.createDataFrame(rows.get(name, []), schema)
           for name, schema in SCHEMAS.items()}
    )


def one(df, **match):
    rows = [r for r in df.collect() if all(r[k] == v for k, v in match.items())]
    assert len(rows) == 1, rows
    return rows[0]
