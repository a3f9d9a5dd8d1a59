"""Dates as texts: which format a column is written in, and reading it strictly."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.functions.expr import quoted

ISO = "iso"  # year-month-day, a time may follow

_TIME = "[ H:mm[:ss]]"
# The formats a column may use besides ISO. Where a column fits two of them equally
# well, the earlier one counts, so the month comes first.
FORMATS = (
    "M/d/yyyy", "d/M/yyyy", "M.d.yyyy", "d.M.yyyy", "M-d-yyyy", "d-M-yyyy",
    "yyyy/M/d", "yyyy.M.d", "yyyyMMdd", "d MMM yyyy", "MMM d, yyyy",
)


def date_value(column: Column, style: str = ISO) -> Column:
    """The date that a text holds in this format, NULL if it holds none."""
    if style == ISO:
        return column.try_cast("date")
    return F.try_to_date(F.trim(column.cast("string")), style + _TIME)


def infer_date_formats(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """The format that most present values of each column have.

    One aggregate reads all values of all columns, so the answer depends neither on the order of
    the rows nor on a sample. ISO wins ties, then the order of FORMATS. Columns that are no texts,
    and columns without a readable value, count as ISO.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    found = [c for c in columns if c in texts]
    if not found:
        return {c: ISO for c in columns}
    styles = (ISO, *FORMATS)
    counts = df.agg(
        *(
            F.count(date_value(quoted(c), style)).alias(f"n{i}_{j}")
            for i, c in enumerate(found)
            for j, style in enumerate(styles)
        )
    ).first()
    best = {
        c: styles[max(range(len(styles)), key=lambda j: (counts[f"n{i}_{j}"], -j))]
        for i, c in enumerate(found)
    }
    return {c: best.get(c, ISO) for c in columns}


def resolve_formats(
    df: DataFrame, columns: Iterable[str], formats: Mapping[str, str] | str = ISO
) -> dict[str, str]:
    """Formats by column from a mapping, one format for all, or ``"infer"``."""
    columns = list(columns)
    if formats == "infer":
        return infer_date_formats(df, columns)
    if isinstance(formats, str):
        return dict.fromkeys(columns, formats)
    return {c: formats.get(c, ISO) for c in columns}
