"""Source tables derived from the driver's parquet files.

One SQL text per table, valid in Spark and DuckDB alike; ``{name}`` stands for a driver
table. ``AS_OF`` is fixed so that results can be compared.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from promolens.sources.tables import SourceTables

AS_OF = date(2001, 6, 30)

VIEW_SQL = {
    "orders": """
SELECT o.o_orderkey AS id, 'N' || CAST(o.o_orderkey AS STRING) AS ordernumber,
       o.o_orderpriority AS shop, o.o_orderdate AS created_date,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' WHEN 2 THEN 'SEK'
            ELSE 'CHF' END AS currency_code,
       CASE WHEN o.o_orderkey % 97 = 0 THEN CAST(0 AS DECIMAL(12,4))
            WHEN o.o_orderkey % 3 = 0 THEN NULL
            WHEN o.o_orderkey % 4 = 0 THEN CAST(1 AS DECIMAL(12,4))
            WHEN o.o_orderkey % 4 = 1 THEN CAST(1.28 AS DECIMAL(12,4))
            ELSE CAST(1.25 AS DECIMAL(12,4)) END AS currencyrate,
       CASE WHEN o.o_orderkey % 53 = 0 THEN '1' WHEN o.o_orderkey % 59 = 0 THEN NULL
            WHEN o.o_orderkey % 5 = 0 THEN ' 0 ' ELSE '0' END AS testorder,
       CASE o.o_orderstatus WHEN 'F' THEN 'ARCHIVED' WHEN 'O' THEN 'EXPORTED'
            ELSE CASE WHEN o.o_orderkey % 2 = 0 THEN 'EXPORTED' ELSE 'CANCELLED' END
            END AS state
FROM {orders} o""",
    "order_items": """
SELECT l_orderkey AS orderid,
       CASE l_linenumber WHEN 7 THEN 'SHIPPING' WHEN 6 THEN 'GIFTCARD'
            ELSE 'PRODUCT' END AS type,
       CASE WHEN l_suppkey % 41 = 0 THEN NULL WHEN l_suppkey % 43 = 0 THEN CAST(0 AS DOUBLE)
            ELSE l_quantity END AS quantity,
       CASE WHEN l_partkey % 61 = 0 THEN NULL
            ELSE CAST(l_extendedprice AS DECIMAL(12,2))
                 * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
            END AS nettotalprice,
       CASE WHEN l_partkey % 25 = 0
            THEN -(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
            END AS coupondiscountdistr
FROM {lineitem}""",
    "refunds": """
SELECT l_orderkey AS orderid FROM {lineitem}
WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity <= 20""",
    "currency_rates": """
SELECT 'EUR' AS currencycode, d.date, CAST(1 AS DECIMAL(10,2)) AS currencyrate FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}) d
UNION ALL
SELECT 'USD', d.date, CAST(1.28 AS DECIMAL(10,2)) FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}) d
UNION ALL
SELECT 'SEK', d.date, CAST(10.24 AS DECIMAL(10,2)) FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}) d
WHERE EXTRACT(DAY FROM d.date) <> 7
UNION ALL
SELECT 'CHF', d.date, CASE WHEN EXTRACT(DAY FROM d.date) = 13 THEN CAST(0 AS DECIMAL(10,2))
                           ELSE CAST(0.5 AS DECIMAL(10,2)) END FROM (
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM {orders}) d""",
    "interactions": """
SELECT 'order' AS interaction_type, 'N' || CAST(o_orderkey AS STRING) AS related_ordernumber,
       CASE WHEN o_orderkey % 71 = 0 THEN NULL ELSE o_custkey END AS external_customerkey,
       o_orderdate AS event_time
FROM {orders}
UNION ALL
SELECT 'order', 'N' || CAST(o_orderkey AS STRING), o_custkey + 1,
       CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END
FROM {orders} WHERE o_orderkey % 10 = 0
UNION ALL
SELECT 'visit', 'N' || CAST(o_orderkey AS STRING), o_custkey + 2,
       o_orderdate + INTERVAL 2 DAY
FROM {orders} WHERE o_orderkey % 11 = 0
UNION ALL
SELECT 'order', CAST(NULL AS STRING), o_custkey, o_orderdate
FROM {orders} WHERE o_orderkey % 101 = 0""",
    "customers": """
SELECT c_custkey AS externalcustomerkey,
       CASE WHEN c_custkey % 83 = 0 THEN NULL ELSE n_name END AS country,
       CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN 'Female'
            ELSE 'Male' END AS gender
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
UNION ALL
SELECT c_custkey, n_name, 'Female'
FROM {customer} JOIN {nation} ON n_nationkey = (c_nationkey + 1) % 25
WHERE c_custkey % 17 = 0
UNION ALL
SELECT CAST(NULL AS BIGINT), n_name, 'Male' FROM {nation} WHERE n_nationkey = 0""",
}


def _driver_tables(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def duckdb_view(name: str) -> str:
    sql = VIEW_SQL[name]
    return sql.format(**{t: t for t in _driver_tables(sql)})


def source_tables(spark: SparkSession, sf_dir: str) -> SourceTables:
    def build(name: str) -> DataFrame:
        sql = VIEW_SQL[name]
        files = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _driver_tables(sql)}
        return spark.sql(sql, **files)

    return SourceTables(**{name: build(name) for name in SourceTables.names()})
