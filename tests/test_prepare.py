from datetime import date

import pytest
from pyspark.sql import functions as F

from promolens.config import TARGET_COLUMN, RunConfig, preset
from promolens.operators import prepare, quality, scoring
from promolens.sources import artifacts

SCHEMA = (
    "externalcustomerkey bigint, as_of_date string, last_order_date string, shops_included int,"
    " orders_12m bigint, unit_price double, share_of_orders_with_discount double,"
    " discount_abs_lifetime_eur double, avg_discount_per_order double, account_age_days int,"
    " registration_flag int, country string, gender string"
)


def row(key, country="DE", orders=1, price=1.0, share=0.0, amount=0.0, shops=1, day="2024-03-31"):
    return (key, day, "2024-03-01", shops, orders, price, share, amount, None, None, 0, country, "f")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


CFG = RunConfig(country_min_share=0.3)


def test_learned_schema_and_training_rows(spark):
    df = frame(
        spark,
        row(1, share=0.5), row(2, amount=3.0, orders=None), row(3, "AT"), row(4, "AT", price=None),
        row(5, None, day="bad"), row(6, "XX"),
    )
    meta = prepare.fit(df, CFG)
    assert meta.major_countries == ("AT", "DE")
    assert meta.feature_columns == (
        "orders_12m", "unit_price", "country_AT", "country_DE", "country_OTHER"
    )
    out = prepare.training_frame(df, meta)
    assert out.columns == [
        "externalcustomerkey", "orders_12m", "unit_price", "y_discount_sensitive",
        "country_AT", "country_DE", "country_OTHER",
    ]
    rows = {r[0]: tuple(r)[1:] for r in out.collect()}
    assert rows == {
        1: (1, 1.0, 1, 0, 1, 0), 2: (0, 1.0, 1, 0, 1, 0), 3: (1, 1.0, 0, 1, 0, 0),
        5: (1, 1.0, 0, 0, 0, 1), 6: (1, 1.0, 0, 0, 0, 1),
    }


def test_other_flag_exists_only_if_needed_and_merges_with_a_literal_other(spark):
    assert "country_OTHER" not in prepare.fit(frame(spark, row(1), row(2)), CFG).feature_columns
    df = frame(spark, row(1, "OTHER"), row(2, "OTHER"), row(3, "DE"), row(4, None))
    meta = prepare.fit(df, RunConfig(country_min_share=0.5))
    assert meta.major_countries == ("OTHER",)
    flags = [r.country_OTHER for r in prepare.training_frame(df, meta).collect()]
    assert flags == [1, 1, 1, 1]


def test_country_share_bound_is_inclusive_and_over_present_values(spark):
    df = frame(spark, row(1), row(2), row(3), row(4, "AT"), row(5, None))
    assert prepare.major_countries(df, 0.25) == ("DE", "AT")
    assert prepare.major_countries(df, 0.26) == ("DE",)


def test_country_names_with_dots(spark):
    df = frame(spark, row(1, "St. Lucia"), row(2, "St. Lucia"))
    meta = prepare.fit(df, CFG)
    aligned = scoring.scoring_frame(df, meta)
    assert aligned.columns[-1] == "country_St. Lucia"
    assert [tuple(r)[-1] for r in aligned.collect()] == [1, 1]


@pytest.mark.parametrize("column", ["share_of_orders_with_discount", "country"])
def test_required_columns(spark, column):
    with pytest.raises(ValueError, match=column):
        prepare.fit(frame(spark, row(1)).drop(column), CFG)
    empty = frame(spark, row(1)).withColumn(column, F.lit(None).cast("double"))
    with pytest.raises(ValueError, match=column):
        prepare.fit(empty, CFG)


def test_text_features_are_refused(spark):
    with pytest.raises(ValueError, match="note"):
        prepare.fit(frame(spark, row(1)).withColumn("note", F.lit("x")), CFG)


def test_older_policy_keeps_flags_that_vary(spark):
    df = frame(spark, row(1, shops=1), row(2, shops=2))
    legacy = preset("legacy").with_changes(country_min_share=0.3)
    assert "shops_included" in prepare.fit(df, legacy).feature_columns
    assert "registration_flag" not in prepare.fit(df, legacy).feature_columns
    assert "shops_included" not in prepare.fit(df, CFG).feature_columns
    # Scoring sees the values that training saw.
    scored = scoring.scoring_frame(df, prepare.fit(df, legacy))
    assert {r.shops_included for r in scored.collect()} == {1, 2}


def test_nan_is_missing_everywhere(spark):
    nan = F.lit(float("nan"))
    df = frame(spark, row(1), row(2)).withColumn("avg_discount_per_order", nan)
    df = df.withColumn("unit_price", nan)
    meta = prepare.fit(df, CFG)
    assert "unit_price" not in meta.feature_columns
    assert prepare.training_frame(df, meta).count() == 2
    no_use = df.withColumn("share_of_orders_with_discount", nan).withColumn(
        "discount_abs_lifetime_eur", F.lit(None).cast("double")
    )
    assert {r[0] for r in prepare.add_target(no_use).select(TARGET_COLUMN).collect()} == {0}
    profile = {r.column_name: r.filled_count for r in quality.table_profile(df).collect()}
    assert profile["unit_price"] == 0 and profile["orders_12m"] == 2
    assert quality.incomplete_rows(df, ["unit_price"]).first()[0] == 2


def test_scoring_frame_keeps_all_rows_and_aligns(spark):
    meta = prepare.PrepMetadata(0.3, ("AT",), ("orders_12m", "gone", "country_AT", "country_OTHER"))
    df = frame(spark, row(1, "AT"), row(1, "AT"), row(2, "ZZ", orders=None), row(3, None, price=None))
    out = scoring.scoring_frame(df, meta)
    assert out.columns == ["externalcustomerkey", *meta.feature_columns]
    assert sorted(map(tuple, out.collect())) == [
        (1, 1, 0, 1, 0), (1, 1, 0, 1, 0), (2, 0, 0, 0, 1), (3, 1, 0, 0, 1)
    ]
    gap = df.withColumn("orders_12m", F.lit(None).cast("bigint"))
    assert {r.orders_12m for r in scoring.scoring_frame(gap, meta).collect()} == {0}


def test_scoring_preconditions(spark):
    meta = prepare.PrepMetadata(0.3, ("AT",), ("orders_12m", "country_AT"))
    df = frame(spark, row(1))
    for column in ("country", "externalcustomerkey"):
        with pytest.raises(ValueError, match=column):
            scoring.scoring_frame(df.drop(column), meta)
    with pytest.raises(ValueError, match="orders_12m"):
        scoring.scoring_frame(df.withColumn("orders_12m", F.lit("many")), meta)
    with pytest.raises(ValueError, match="no value"):
        scoring.require_country(df.withColumn("country", F.lit(None).cast("string")))


def test_nan_target_source_counts_as_no_use_after_normalising(spark):
    from promolens.sources.text import normalize_missing

    df = frame(spark, row(1, share=float("nan")), row(2, share=None, amount=None), row(3, share=0.1))
    found = prepare.add_target(normalize_missing(df)).collect()
    assert [r.y_discount_sensitive for r in found] == [0, 0, 1]


def test_metadata_survives_storage(spark, tmp_path):
    meta = prepare.PrepMetadata(0.01, ("DE", "St. Lucia"), ("a", "country_DE"))
    artifacts.save_metadata(spark, meta, str(tmp_path / "m"))
    assert artifacts.load_metadata(spark, str(tmp_path / "m")) == meta
    with pytest.raises(FileNotFoundError, match="metadata"):
        artifacts.load_metadata(spark, str(tmp_path / "none"))


def test_quality_reports(spark):
    df = frame(spark, row(1, orders=None), row(2, shops=2, day="bad"), row(3, day=None))
    fails = {r.column_name: (r.missing_count, r.unparsed_count)
             for r in quality.date_parse_failures(df).collect()}
    assert fails == {"as_of_date": (2, 1), "last_order_date": (0, 0)}
    constant = {r.column_name: r.is_constant
                for r in quality.constant_columns(df, ["shops_included", "registration_flag",
                                                       "account_age_days", "as_of_date"]).collect()}
    assert constant == {"shops_included": 0, "registration_flag": 1, "account_age_days": 1,
                        "as_of_date": 0}
    fills = {r.column_name: r.filled_with_zero for r in quality.fill_report(df).collect()}
    assert fills == {"orders_12m": 1, "avg_discount_per_order": 3}
    assert prepare.all_null_columns(df) == ["avg_discount_per_order", "account_age_days"]
    dated = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 2, 1), date(2024, 1, 31)),
         (None, date(2024, 1, 1), date(2024, 1, 31)), (date(2024, 2, 1), None, None)],
        "first_order_date date, last_order_date date, as_of_date date")
    assert tuple(quality.impossible_dates(dated).first()) == (1, 3)
