"""The binned feature store: quantile cuts of every feature, and rows as small bin numbers."""

from __future__ import annotations

from dataclasses import dataclass

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.functions.expr import ident, sql_columns

ACCURACY = 100  # ranks of a cut are right to one part in this many of a bin


@dataclass(frozen=True)
class Bins:
    """Ascending cuts of each feature; bin ``i`` holds values up to cut ``i``, the last the rest."""

    names: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]

    @property
    def width(self) -> int:
        return 1 + max(map(len, self.cuts), default=0)


def fit_bins(df: DataFrame, names, max_bins: int) -> Bins:
    """Cuts at the ``i / max_bins`` quantiles, equal ones once, in one pass over the rows.

    The sketches of the tasks are merged and bounded by ``max_bins``, whatever the rows. NULL and
    NaN count nowhere; a feature with one value, or without any, has no cut. A table without rows
    gives no cuts. The largest value is no cut, because nothing lies above it.
    """
    if not 2 <= max_bins <= 32_767:
        raise ValueError("max_bins must lie in [2, 32767]")
    slots = [f"f{i}" for i in range(len(names))]
    values = df.select(
        *sql_columns(*(f"CAST({ident(n)} AS DOUBLE) AS {s}" for n, s in zip(names, slots)))
    )
    shares = [i / max_bins for i in range(1, max_bins + 1)]
    found = values.approxQuantile(slots, shares, 1 / (ACCURACY * max_bins))
    cuts = tuple(tuple(sorted({q for q in each if q < each[-1]})) for each in found)
    return Bins(tuple(names), cuts)


def binned(df: DataFrame, bins: Bins, keep: list[Column], to: str = "x") -> DataFrame:
    """``keep`` and one array of bin numbers (``smallint``) in the order of the features.

    A missing value is read as 0, as scoring does.
    """
    slots = [f"_f{i}" for i in range(len(bins.names))]
    flat = df.select(
        *keep,
        *sql_columns(
            *(f"coalesce(nanvl(CAST({ident(n)} AS DOUBLE), NULL), 0D) AS {s}"
              for n, s in zip(bins.names, slots, strict=True))
        ),
    )
    inner = [s for s, c in zip(slots, bins.cuts, strict=True) if c]
    if inner:
        # The bucketizer's ranges hold their lower end, a bin its upper one.
        splits = [
            [-math.inf, *(math.nextafter(c, math.inf) for c in cuts), math.inf]
            for cuts in bins.cuts if cuts
        ]
        flat = Bucketizer(
            splitsArray=splits, inputCols=inner, outputCols=[f"{s}_bin" for s in inner]
        ).transform(flat)
    numbers = [
        F.col(f"{s}_bin").cast("smallint") if c else F.lit(0).cast("smallint")
        for s, c in zip(slots, bins.cuts, strict=True)
    ]
    kept = [c for c in flat.columns if not c.startswith("_f")]
    return flat.select(*kept, F.array(*numbers).alias(to))
