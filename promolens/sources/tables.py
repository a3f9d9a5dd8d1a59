"""The six source tables of the feature job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# Default table names and the columns each table must offer.
SOURCE_NAMES = {
    "orders": "orders",
    "order_items": "orderitems",
    "refunds": "refunds",
    "currency_rates": "currencyrates",
    "interactions": "customer_interactions_fact",
    "customers": "dim_customers",
}
REQUIRED_COLUMNS = {
    "orders": (
        "id", "ordernumber", "shop", "created_date",
        "currency_code", "currencyrate", "testorder", "state",
    ),
    "order_items": ("orderid", "type", "quantity", "nettotalprice", "coupondiscountdistr"),
    "refunds": ("orderid",),
    "currency_rates": ("currencycode", "date", "currencyrate"),
    "interactions": (
        "interaction_type", "related_ordernumber", "external_customerkey", "event_time",
    ),
    "customers": ("externalcustomerkey", "country", "gender"),
}


@dataclass(frozen=True)
class SourceTables:
    """Source DataFrames; column pruning is left to Catalyst."""

    orders: DataFrame
    order_items: DataFrame
    refunds: DataFrame
    currency_rates: DataFrame
    interactions: DataFrame
    customers: DataFrame

    def __post_init__(self) -> None:
        for name, columns in REQUIRED_COLUMNS.items():
            absent = [c for c in columns if c not in getattr(self, name).columns]
            if absent:
                raise ValueError(f"table {name} lacks columns {absent}")

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, names: Mapping[str, str] = SOURCE_NAMES
    ) -> SourceTables:
        return cls(**{k: spark.read.parquet(f"{root}/{n}.parquet") for k, n in names.items()})

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, names: Mapping[str, str] = SOURCE_NAMES
    ) -> SourceTables:
        return cls(**{k: spark.table(n) for k, n in names.items()})

    @classmethod
    def names(cls) -> list[str]:
        return [f.name for f in fields(cls)]
