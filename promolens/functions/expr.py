"""Column expressions shared by the operators."""

from __future__ import annotations

import calendar
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Look-back windows, as (unit, length).
WINDOWS = {
    "15d": ("day", 15),
    "30d": ("day", 30),
    "3m": ("month", 3),
    "6m": ("month", 6),
    "12m": ("month", 12),
}


def months_before(day: date, months: int) -> date:
    """Calendar months back, clipped to the end of a shorter month."""
    year, month0 = divmod(day.year * 12 + day.month - 1 - months, 12)
    last = calendar.monthrange(year, month0 + 1)[1]
    return date(year, month0 + 1, min(day.day, last))


def window_start(as_of: date, window: str) -> date:
    """First day (inclusive) of a look-back window."""
    unit, length = WINDOWS[window]
    return as_of - timedelta(days=length) if unit == "day" else months_before(as_of, length)


def ident(name: str) -> str:
    """A column name for SQL text, also when it holds dots or blanks."""
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column by its literal name, also when the name holds dots or blanks."""
    return F.col(ident(name))


def present(df: DataFrame, name: str) -> str:
    """SQL for the value, with NaN taken as missing."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return f"if(isnan({ident(name)}), NULL, {ident(name)})"
    return ident(name)


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """0 for missing values of the named columns, types kept."""
    filled = set(names)

    def value(field: T.StructField) -> str:
        name = ident(field.name)
        if field.name not in filled:
            return name
        zero = f"CAST(0 AS {field.dataType.simpleString()})"
        return f"coalesce({present(df, field.name)}, {zero}) AS {name}"

    return df.selectExpr(*(value(f) for f in df.schema))


def falls_between(df: DataFrame, name: str, first: date, last: date) -> Column:
    """``first <= date(column) <= last``, on the raw column so the scan can use it."""
    column = quoted(name)
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        until = last + timedelta(days=1)
        return (column >= F.lit(first).cast(kind)) & (column < F.lit(until).cast(kind))
    if isinstance(kind, T.DateType):
        return column.between(F.lit(first), F.lit(last))
    return column.try_cast("date").between(F.lit(first), F.lit(last))


def day(value: date) -> str:
    return f"DATE '{value.isoformat()}'"


def since(column: str, as_of: date, window: str) -> str:
    """SQL condition: the day lies in the look-back window."""
    return f"{column} >= {day(window_start(as_of, window))}"


def ratio(numerator: str, denominator: str) -> str:
    """SQL for one double division, NULL unless the denominator is positive."""
    quotient = f"CAST({numerator} AS DOUBLE) / CAST({denominator} AS DOUBLE)"
    return f"CASE WHEN {denominator} > 0 THEN {quotient} END"


def sql_columns(*expressions: str) -> list[Column]:
    return [F.expr(e) for e in expressions]


def key_hash(key: Column, seed: int) -> Column:
    """Uniform 60-bit value of a key, the same on every run and in every engine."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
