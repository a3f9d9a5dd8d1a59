"""Profiling and sanity checks; each is one aggregate over the table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import DATE_COLUMNS, ID_COLUMN, WINDOW_TOKENS, ZERO_FILLED_COLUMN
from promolens.functions.dates import ISO, date_value, resolve_formats
from promolens.functions.expr import present, quoted

NUMERIC = (T.NumericType, T.BooleanType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NUMERIC)]


def window_columns(df: DataFrame) -> list[str]:
    """Numeric columns named after a look-back window, plus the zero-filled average."""
    numeric = numeric_columns(df)
    windowed = [c for c in numeric if any(token in c for token in WINDOW_TOKENS)]
    return windowed + [c for c in numeric if c == ZERO_FILLED_COLUMN]


def _long_form(totals: DataFrame, rows: Sequence[Sequence[Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per entry."""
    return totals.select(F.inline(F.array(*(F.struct(*row) for row in rows))))


def table_profile(df: DataFrame) -> DataFrame:
    """Position, name, type, row count and filled values of every column."""
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.expr(f"count({present(df, f.name)}) AS c{i}") for i, f in enumerate(df.schema)),
    )
    return _long_form(
        totals,
        [
            (
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("n").alias("row_count"),
                F.col(f"c{i}").alias("filled_count"),
            )
            for i, f in enumerate(df.schema)
        ],
    )


def coerce_dates(
    df: DataFrame,
    columns: Iterable[str] = DATE_COLUMNS,
    formats: Mapping[str, str] | str = ISO,
) -> DataFrame:
    """Read as dates; what does not parse becomes NULL.

    ``formats`` names the format of each column, one for all, or ``"infer"``: see
    ``infer_date_formats``.
    """
    found = [c for c in columns if c in df.columns]
    styles = resolve_formats(df, found, formats)
    return df.withColumns({c: date_value(quoted(c), styles[c]) for c in found})


def date_parse_failures(
    df: DataFrame,
    columns: Iterable[str] = DATE_COLUMNS,
    formats: Mapping[str, str] | str = ISO,
) -> DataFrame:
    """Per date column: missing values after parsing, and how many of them held a text."""
    found = [c for c in columns if c in df.columns]
    styles = resolve_formats(df, found, formats)
    parsed = {c: date_value(quoted(c), styles[c]) for c in found}
    totals = df.agg(
        *(F.count_if(parsed[c].isNull()).alias(f"m{i}") for i, c in enumerate(found)),
        *(
            F.count_if(parsed[c].isNull() & quoted(c).isNotNull()).alias(f"b{i}")
            for i, c in enumerate(found)
        ),
    )
    return _long_form(
        totals,
        [
            (
                F.lit(c).alias("column_name"),
                F.col(f"m{i}").alias("missing_count"),
                F.col(f"b{i}").alias("unparsed_count"),
            )
            for i, c in enumerate(found)
        ],
    )


def date_summary(df: DataFrame, columns: Iterable[str] = DATE_COLUMNS) -> DataFrame:
    """Count, first and last day, mean and quartiles (as days since 1970-01-01).

    Exact percentiles keep one counter per distinct day, so their state is bounded by the
    calendar, not by the rows.
    """
    found = [c for c in columns if c in df.columns]
    aggregates = []
    for i, c in enumerate(found):
        day = F.unix_date(quoted(c))
        aggregates += [
            F.count(day).alias(f"n{i}"),
            F.min(quoted(c)).alias(f"lo{i}"),
            F.max(quoted(c)).alias(f"hi{i}"),
            F.avg(day).alias(f"avg{i}"),
            F.percentile(day, [0.25, 0.5, 0.75]).alias(f"q{i}"),
        ]
    return _long_form(
        df.agg(*aggregates),
        [
            (
                F.lit(c).alias("column_name"),
                F.col(f"n{i}").alias("filled_count"),
                F.col(f"avg{i}").alias("mean_day"),
                F.col(f"lo{i}").alias("first_date"),
                F.col(f"q{i}")[0].alias("q25_day"),
                F.col(f"q{i}")[1].alias("q50_day"),
                F.col(f"q{i}")[2].alias("q75_day"),
                F.col(f"hi{i}").alias("last_date"),
            )
            for i, c in enumerate(found)
        ],
    )


def impossible_dates(df: DataFrame) -> DataFrame:
    """Rows whose first or last order lies after the as-of date."""
    late = (F.col("first_order_date") > F.col("as_of_date")) | (
        F.col("last_order_date") > F.col("as_of_date")
    )
    return df.agg(F.count_if(late).alias("impossible_rows"), F.count(F.lit(1)).alias("all_rows"))


def constant_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Whether a column holds one single value, a missing value counting as one.

    Smallest equals largest replaces a distinct count, so all columns share one pass.
    """
    found = [c for c in columns if c in df.columns]
    totals = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(F.expr(f"count({present(df, c)}) AS f{i}") for i, c in enumerate(found)),
        *(F.expr(f"min({present(df, c)}) AS lo{i}") for i, c in enumerate(found)),
        *(F.expr(f"max({present(df, c)}) AS hi{i}") for i, c in enumerate(found)),
    )

    def constant(i: int) -> Column:
        filled = F.col(f"f{i}")
        same = (filled == F.col("n")) & F.col(f"lo{i}").eqNullSafe(F.col(f"hi{i}"))
        return (filled == 0) | same

    return _long_form(
        totals,
        [
            (
                F.lit(c).alias("column_name"),
                constant(i).cast("int").alias("is_constant"),
                (F.col("n") - F.col(f"f{i}")).alias("missing_count"),
            )
            for i, c in enumerate(found)
        ],
    )


def fill_report(df: DataFrame) -> DataFrame:
    """Missing values the window fill will set to 0, per column."""
    columns = window_columns(df)
    totals = df.agg(
        *(F.expr(f"count_if({present(df, c)} IS NULL) AS c{i}") for i, c in enumerate(columns))
    )
    return _long_form(
        totals,
        [
            (F.lit(c).alias("column_name"), F.col(f"c{i}").alias("filled_with_zero"))
            for i, c in enumerate(columns)
        ],
    )


def incomplete_rows(df: DataFrame, columns: Iterable[str], key: str = ID_COLUMN) -> DataFrame:
    """How many rows still miss any of ``columns``."""
    complete = F.lit(True)
    for c in columns:
        if c != key:
            complete = complete & F.expr(f"{present(df, c)} IS NOT NULL")
    return df.agg(F.count_if(~complete).alias("incomplete_rows"))
