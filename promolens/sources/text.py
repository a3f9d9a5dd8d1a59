"""Read a raw feature file in CSV form, and put missing values into one shape."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promolens.config import DATE_COLUMNS, FEATURE_FIELDS, ID_COLUMN
from promolens.functions.dates import ISO, date_value, resolve_formats
from promolens.functions.expr import present, quoted

# Texts that a data-frame CSV reader takes as missing by default. Note that
# the ISO country code "NA" is among them.
DEFAULT_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Only the empty field is missing; keeps the country "NA".
EMPTY_ONLY = ("",)
WHOLE_NUMBERS = ("smallint", "int", "bigint")


def normalize_missing(df: DataFrame, tokens: Iterable[str] = ()) -> DataFrame:
    """NaN becomes NULL in float columns, ``tokens`` become NULL in string columns."""
    tokens = list(tokens)

    def clean(field: T.StructField) -> Column:
        column = F.expr(present(df, field.name))
        if isinstance(field.dataType, T.StringType) and tokens:
            column = F.when(~column.isin(tokens), column)
        return column.alias(field.name)

    return df.select(*(clean(f) for f in df.schema))


def _typed(name: str, kind: str, on_bad: str, style: str) -> Column:
    text = quoted(name)
    if kind == "string":
        return text
    value = date_value(text, style) if kind == "date" else text.try_cast(kind)
    if kind in WHOLE_NUMBERS:
        number = text.try_cast("double")  # whole numbers are often written as 3.0
        value = F.coalesce(value, F.when(number == F.floor(number), number).try_cast(kind))
    if name in DATE_COLUMNS or on_bad == "null":
        return value
    problem = F.raise_error(F.concat(F.lit(f"column {name}: not a {kind}: "), text))
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(problem.cast(kind))


def _extra_types(raw: DataFrame, names: list[str]) -> dict[str, str]:
    """Types of unknown columns, from one pass over all: double if every present value is a
    number, boolean if every one is True or False, else text."""
    if not names:
        return {}
    counts = []
    for i, c in enumerate(names):
        filled = quoted(c).isNotNull()
        truth = F.lower(quoted(c)).isin("true", "false")
        counts.append(F.count_if(filled & quoted(c).try_cast("double").isNull()).alias(f"n{i}"))
        counts.append(F.count_if(filled & ~truth).alias(f"b{i}"))
    bad = raw.agg(*counts).first()
    kinds = {}
    for i, c in enumerate(names):
        if bad[f"n{i}"] == 0:
            kinds[c] = "double"
        elif bad[f"b{i}"] == 0:
            kinds[c] = "boolean"
    return kinds


def read_features_csv(
    spark: SparkSession,
    path: str,
    missing: Iterable[str] = DEFAULT_MISSING,
    types: Iterable[tuple[str, str]] = FEATURE_FIELDS,
    on_bad: str = "raise",
    key_type: str | None = None,
    multi_line: bool = False,
    date_formats: Mapping[str, str] | str = ISO,
) -> DataFrame:
    """Read a raw feature CSV by header name, without guessing the known types.

    Dates that do not parse become NULL. Other values that do not fit their column raise
    when the row is read, or become NULL with ``on_bad="null"``. Columns outside
    ``types`` become double if all their values are numbers, boolean if all are True or False,
    and stay text otherwise. ``key_type`` replaces the type of the customer key, as for ids that
    are texts. ``multi_line`` allows line breaks inside quoted fields, at the price of one task
    for each file. ``date_formats`` names the format of each date column, one for all, or
    ``"infer"``, which costs one more pass over the dates.
    """
    if on_bad not in ("raise", "null"):
        raise ValueError(f"unknown on_bad: {on_bad}")
    reader = spark.read.option("header", True).option("escape", '"')
    raw = reader.option("multiLine", multi_line).csv(path)
    raw = normalize_missing(raw, missing)
    kinds = dict(types)
    if key_type is not None:
        kinds[ID_COLUMN] = key_type
    kinds |= _extra_types(raw, [c for c in raw.columns if c not in kinds])
    dates = [c for c in raw.columns if kinds.get(c) == "date"]
    styles = resolve_formats(raw, dates, date_formats)
    typed = raw.select(
        *(
            _typed(c, kinds.get(c, "string"), on_bad, styles.get(c, ISO)).alias(c)
            for c in raw.columns
        )
    )
    return normalize_missing(typed)
