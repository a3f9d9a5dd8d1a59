"""Every argument check over the feature table: what raises, and what the rest gives."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import ID_COLUMN, SEGMENT_LABELS, TARGET_COLUMN, RunConfig, preset
from promolens.operators import prepare, scoring, segments, training

_COLUMN = "orders_lifetime"


def _as_text(df: DataFrame) -> DataFrame:
    return df.withColumn(_COLUMN, F.concat(F.lit("n"), F.col(_COLUMN)))


def argument_checks(df: DataFrame, meta: prepare.PrepMetadata) -> DataFrame:
    """(check_name, raised, rows_out): one row a check; rows only of calls that do not raise."""
    proxy = df.select(ID_COLUMN, F.col("share_of_items_discounted").alias("score"))
    ready = prepare.training_frame(df, meta)
    named = meta.feature_columns

    def top(t1: float, t2: float) -> DataFrame:
        return segments.bucketize(proxy, t1, t2).where(F.col("segment") == SEGMENT_LABELS[-1])

    def legacy() -> DataFrame:
        older = preset("legacy")
        return top(older.t1, older.t2)

    def chosen(rows: DataFrame, names=None) -> DataFrame:
        return rows.select(*training.feature_names(rows, names))

    def with_country(rows: DataFrame) -> DataFrame:
        scoring.require_country(rows)
        return rows

    def configured(**changes) -> DataFrame:
        cfg = RunConfig(**changes)
        return top(cfg.t1, cfg.t2)

    calls: dict[str, Callable[[], DataFrame]] = {
        "prepare": lambda: ready,
        "prepare_column_absent": lambda: prepare.training_frame(df.drop(_COLUMN), meta),
        "prepare_text_feature": lambda: prepare.training_frame(_as_text(df), meta),
        "features_all": lambda: chosen(ready),
        "features_named": lambda: chosen(ready, named),
        "features_target_absent": lambda: chosen(ready.drop(TARGET_COLUMN)),
        "features_column_absent": lambda: chosen(ready.drop(_COLUMN), named),
        "score": lambda: scoring.scoring_frame(with_country(df), meta),
        "score_feature_absent": lambda: scoring.scoring_frame(df.drop(_COLUMN), meta),
        "score_key_absent": lambda: scoring.scoring_frame(df.drop(ID_COLUMN), meta),
        "score_country_absent": lambda: scoring.scoring_frame(df.drop("country"), meta),
        "score_country_empty": lambda: with_country(df.withColumn("country", F.lit(None))),
        "align_text_feature": lambda: scoring.align(_as_text(df), named),
        "segments": lambda: top(0.2, 0.5),
        "segments_score_absent": lambda: segments.bucketize(df),
        "segments_thresholds_equal": lambda: top(0.5, 0.5),
        "segments_thresholds_reversed": lambda: top(0.5, 0.2),
        "segments_threshold_one": lambda: top(0.2, 1.0),
        "config": lambda: configured(t1=0.3, t2=0.6),
        "config_thresholds_reversed": lambda: configured(t1=0.6, t2=0.3),
        "config_test_size": lambda: configured(test_size=1.5),
        "config_country_share": lambda: configured(country_min_share=0.0),
        "config_split_mode": lambda: configured(split_mode="other"),
        "config_drop_policy": lambda: configured(drop_policy="other"),
        "preset_legacy": legacy,
        "preset_unknown": lambda: [preset("other")],
    }
    seen = []
    for name, call in calls.items():
        try:
            seen.append((name, False, call().count()))
        except ValueError:
            seen.append((name, True, None))
    return df.sparkSession.createDataFrame(
        seen, "check_name string, raised boolean, rows_out long"
    )


def _above(threshold: float) -> str:
    score = "share_of_items_discounted"
    return f"SELECT count(*) FROM features WHERE {score} > {threshold} AND {score} <= 1"


# What each call gives that does not raise.
_GIVES = {
    "prepare": "SELECT count(*) FROM ready",
    "features_all": "SELECT count(*) FROM ready",
    "features_named": "SELECT count(*) FROM ready",
    "score": "SELECT count(*) FROM features",
    "score_feature_absent": "SELECT count(*) FROM features",
    "segments": _above(0.5),
    "config": _above(0.6),
    "preset_legacy": _above(0.6),
}
_RAISES = (
    "prepare_column_absent", "prepare_text_feature", "features_target_absent",
    "features_column_absent", "score_key_absent", "score_country_absent", "score_country_empty",
    "align_text_feature", "segments_score_absent", "segments_thresholds_equal",
    "segments_thresholds_reversed", "segments_threshold_one", "config_thresholds_reversed",
    "config_test_size", "config_country_share", "config_split_mode", "config_drop_policy",
    "preset_unknown",
)
SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS check_name, FALSE AS raised, ({q}) AS rows_out" for n, q in _GIVES.items()]
    + [f"SELECT '{n}', TRUE, CAST(NULL AS BIGINT)" for n in _RAISES]
)
