"""Run one query in Spark and DuckDB and compare whole results."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _row(values) -> tuple:
    return tuple(
        float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in values
    )


def difference(spark_df, connection, sql: str) -> str | None:
    """None if columns and row multisets agree exactly, else a short description."""
    result = connection.execute(sql)
    expected_names = [d[0] for d in result.description]
    names = sorted(spark_df.columns)
    if names != sorted(expected_names):
        return f"columns differ: {set(names) ^ set(expected_names)}"
    order = [expected_names.index(n) for n in names]
    expected = Counter(_row(r[i] for i in order) for r in result.fetchall())
    actual = Counter(_row(r) for r in spark_df.select(*(f"`{n}`" for n in names)).collect())
    if expected == actual:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"{sum(missing.values())} of {sum(expected.values())} rows differ\n{names}\n"
        f"expected {list(missing)[:2]}\nactual   {list(extra)[:2]}"
    )
