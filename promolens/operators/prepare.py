"""Turn feature rows into model input: learn the data-dependent schema once, then apply it."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.config import (
    COUNTRY_COLUMN,
    DATE_COLUMNS,
    DROPPED_COLUMNS,
    ID_COLUMN,
    LEAKAGE_COLUMNS,
    OTHER_COUNTRY,
    TARGET_COLUMN,
    TARGET_SOURCES,
    RunConfig,
)
from promolens.functions.expr import fill_zero, ident, present
from promolens.operators.quality import NUMERIC, coerce_dates, window_columns


@dataclass(frozen=True)
class PrepMetadata:
    """What preparation learned; travels with the model."""

    country_min_share: float
    major_countries: tuple[str, ...]
    feature_columns: tuple[str, ...]
    target_column: str = TARGET_COLUMN
    notes: str = "written by the preparation step; reuse it unchanged for scoring"

    def to_record(self) -> dict:
        return json.loads(json.dumps(asdict(self)))

    @classmethod
    def from_record(cls, record: dict) -> PrepMetadata:
        known = {**record}
        for name in ("major_countries", "feature_columns"):
            known[name] = tuple(known[name])
        return cls(**known)


def _require(df: DataFrame, columns) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")


def _require_numeric(df: DataFrame, columns) -> None:
    text = [c for c in columns if not isinstance(df.schema[c].dataType, NUMERIC)]
    if text:
        raise ValueError(f"non-numeric feature columns: {text}")


def all_null_columns(df: DataFrame) -> list[str]:
    """Columns without a single value (NaN is none), found in one aggregate."""
    counts = (f"count({present(df, c)}) AS c{i}" for i, c in enumerate(df.columns))
    filled = df.selectExpr(*counts).first()
    return [c for c, n in zip(df.columns, filled) if n == 0]


def drop_all_null(df: DataFrame) -> DataFrame:
    empty = set(all_null_columns(df))
    return df.selectExpr(*(ident(c) for c in df.columns if c not in empty))


def fill_windows(df: DataFrame) -> DataFrame:
    """0 for a missing window measure: no activity in the window."""
    return fill_zero(df, window_columns(df))


def add_target(df: DataFrame) -> DataFrame:
    """1 for any coupon use, else 0; a missing source (NULL or NaN) counts as no use."""
    _require(df, TARGET_SOURCES)
    used = " OR ".join(f"coalesce({present(df, c)} > 0, false)" for c in TARGET_SOURCES)
    return df.withColumn(TARGET_COLUMN, F.expr(f"CAST({used} AS INT)"))


def target_distribution(df: DataFrame) -> DataFrame:
    """Rows and share per target value."""
    counts = df.groupBy(TARGET_COLUMN).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def country_share(df: DataFrame) -> DataFrame:
    """Rows per country and their share of the rows that have one."""
    _require(df, [COUNTRY_COLUMN])
    counts = (
        df.filter(F.col(COUNTRY_COLUMN).isNotNull())
        .groupBy(COUNTRY_COLUMN)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    total = counts.agg(F.sum("row_count")).scalar()
    return counts.withColumn("share", F.col("row_count") / total)


def major_countries(df: DataFrame, min_share: float) -> tuple[str, ...]:
    """Countries with at least ``min_share`` of the rows (so at most 1/min_share of them).

    ``RunConfig`` asks for a share above 0, which bounds what the driver gets.
    """
    major = country_share(df).filter(F.col("share") >= min_share)
    ranked = major.orderBy(F.desc("row_count"), COUNTRY_COLUMN).collect()
    return tuple(row[COUNTRY_COLUMN] for row in ranked)


def grouped_country(majors: tuple[str, ...]) -> Column:
    """The country if it is a major one, else OTHER; a missing country is OTHER too."""
    country = F.col(COUNTRY_COLUMN)
    if not majors:
        return F.lit(OTHER_COUNTRY)
    return F.when(country.isin(*majors), country).otherwise(OTHER_COUNTRY)


def country_flags(values) -> dict[str, str]:
    """Flag column per grouped country value, in sorted order."""
    return {f"{COUNTRY_COLUMN}_{v}": v for v in sorted(set(values))}


def encode_country(df: DataFrame, majors: tuple[str, ...], flags: dict[str, str]) -> DataFrame:
    """Replace the country by 0/1 flags, appended last."""
    _require(df, [COUNTRY_COLUMN])
    grouped = grouped_country(majors)
    return df.select(
        *(ident(c) for c in df.columns if c != COUNTRY_COLUMN),
        *((grouped == v).cast("int").alias(name) for name, v in flags.items()),
    )


def _droppable(df: DataFrame, policy: str) -> set[str]:
    """Columns that never become features; the older policy keeps varying flags."""
    dropped = set(DROPPED_COLUMNS)
    if policy == "always":
        return dropped
    optional = [c for c in DROPPED_COLUMNS if c != "gender" and c in df.columns]
    if not optional:
        return dropped
    probe = df.agg(
        F.count(F.lit(1)).alias("n"),
        *(
            F.expr(
                f"struct(count({v}) AS filled, min({v}) AS lo, max({v}) AS hi) AS {ident(c)}"
            )
            for c, v in ((c, present(df, c)) for c in optional)
        ),
    ).first()

    def varies(c: str) -> bool:
        filled, lo, hi = probe[c]
        return 0 < filled and (filled < probe["n"] or lo != hi)

    return dropped - {c for c in optional if varies(c)}


def _numeric_feature_names(df: DataFrame, dropped: set[str]) -> list[str]:
    excluded = {ID_COLUMN, COUNTRY_COLUMN, TARGET_COLUMN}
    excluded.update(DATE_COLUMNS, LEAKAGE_COLUMNS, dropped)
    return [c for c in df.columns if c not in excluded]


def _clean(df: DataFrame) -> DataFrame:
    return fill_windows(coerce_dates(df))


def fit(df: DataFrame, cfg: RunConfig = RunConfig()) -> PrepMetadata:
    """Learn which columns and countries become features.

    The only step of preparation that runs jobs: one aggregate over all columns and one
    count by country. Give it a stored table, not a long lazy plan.
    """
    _require(df, [*TARGET_SOURCES, COUNTRY_COLUMN])
    dates = coerce_dates(df)
    empty = set(all_null_columns(dates))
    kept = dates.selectExpr(*(ident(c) for c in dates.columns if c not in empty))
    _require(kept, [*TARGET_SOURCES, COUNTRY_COLUMN])
    names = _numeric_feature_names(kept, _droppable(kept, cfg.drop_policy))
    _require_numeric(kept, names)

    majors = major_countries(kept, cfg.country_min_share)
    is_other = ~F.coalesce(F.col(COUNTRY_COLUMN).isin(*majors), F.lit(False))
    any_other = not kept.filter(is_other).select(COUNTRY_COLUMN).isEmpty()
    flags = country_flags([*majors, *([OTHER_COUNTRY] if any_other else [])])
    return PrepMetadata(cfg.country_min_share, majors, (*names, *flags))


def flag_columns(meta: PrepMetadata) -> dict[str, str]:
    """The country flags among the features, with the value each stands for."""
    flags = country_flags([*meta.major_countries, OTHER_COUNTRY])
    return {name: v for name, v in flags.items() if name in meta.feature_columns}


def training_frame(df: DataFrame, meta: PrepMetadata) -> DataFrame:
    """Customer key, numeric features, target and country flags; complete rows only."""
    flags = flag_columns(meta)
    numeric = [c for c in meta.feature_columns if c not in flags]
    labelled = add_target(_clean(df))
    _require(labelled, numeric)
    _require_numeric(labelled, numeric)
    key = [ID_COLUMN] if ID_COLUMN in df.columns else []
    kept = labelled.selectExpr(*map(ident, [*key, *numeric, TARGET_COLUMN, COUNTRY_COLUMN]))
    if numeric:
        kept = kept.filter(" AND ".join(f"{present(kept, c)} IS NOT NULL" for c in numeric))
    return encode_country(kept, meta.major_countries, flags)


def replay(df: DataFrame, meta: PrepMetadata) -> DataFrame:
    """The same preparation for scoring: stored countries, no target, no row dropped.

    Columns come out as found, before alignment with the training schema. A flag that the older
    policy kept as a feature is kept here too, so training and scoring see the same values.
    """
    _require(df, [ID_COLUMN, COUNTRY_COLUMN])
    clean = _clean(df)
    names = _numeric_feature_names(clean, set(DROPPED_COLUMNS) - set(meta.feature_columns))
    flags = country_flags([*meta.major_countries, OTHER_COUNTRY])
    kept = clean.selectExpr(*map(ident, [ID_COLUMN, *names, COUNTRY_COLUMN]))
    return encode_country(kept, meta.major_countries, flags)


def metadata_rows(df: DataFrame, meta: PrepMetadata) -> DataFrame:
    """The metadata in long form: key, position, value."""
    entries = []
    for key, value in meta.to_record().items():
        values = value if isinstance(value, list) else [value]
        entries += [(key, i, str(v)) for i, v in enumerate(values)]
    spark = df.sparkSession
    return spark.createDataFrame(entries, "key string, position int, value string")
