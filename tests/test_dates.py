from datetime import date

import pytest
from pyspark.sql import functions as F

from promolens.functions.dates import FORMATS, ISO, date_value, infer_date_formats
from promolens.operators import quality
from promolens.sources.text import read_features_csv

DAY = date(2001, 6, 30)


@pytest.mark.parametrize(
    ("text", "style"),
    [
        ("2001-06-30", ISO), ("2001-06-30 10:00:00", ISO), ("6/30/2001", "M/d/yyyy"),
        ("06/30/2001 9:05", "M/d/yyyy"), ("30/06/2001", "d/M/yyyy"), ("30.6.2001", "d.M.yyyy"),
        ("30.06.2001 23:59:59", "d.M.yyyy"), ("30-06-2001", "d-M-yyyy"),
        ("2001/06/30", "yyyy/M/d"), ("20010630", "yyyyMMdd"), ("30 Jun 2001", "d MMM yyyy"),
        ("Jun 30, 2001", "MMM d, yyyy"),
    ],
)
def test_the_format_of_a_column_is_found_and_read(spark, text, style):
    df = spark.createDataFrame([(text,), (None,), ("unknown",)], "d string")
    assert infer_date_formats(df, ["d"]) == {"d": style}
    got = {r[0] for r in df.select(date_value(F.col("d"), style)).collect()}
    assert got == {DAY, None}


def test_most_values_decide_and_the_rest_is_missing(spark):
    """One day that only fits day-first among ambiguous ones makes the column day-first."""
    days = ["01.02.2001", "03.04.2001", "30.06.2001", "2001-06-30", "31.02.2001", ""]
    df = spark.createDataFrame([(d,) for d in days], "first_order_date string")
    got = quality.coerce_dates(df, formats="infer")
    assert [r[0] for r in got.collect()] == [
        date(2001, 2, 1), date(2001, 4, 3), DAY, None, None, None
    ]


def test_ambiguous_columns_have_the_month_first(spark):
    df = spark.createDataFrame([("01/02/2001",)], "d string")
    assert infer_date_formats(df, ["d"]) == {"d": "M/d/yyyy"}


def test_empty_columns_and_dates_count_as_iso(spark):
    df = spark.createDataFrame([(None, DAY)], "d string, `e.f` date")
    assert infer_date_formats(df, ["d", "e.f"]) == {"d": ISO, "e.f": ISO}
    assert infer_date_formats(df.where("false"), ["d"]) == {"d": ISO}
    assert len(set(FORMATS)) == len(FORMATS)


def test_reader_with_inferred_and_given_formats(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("externalcustomerkey,as_of_date\n1,30.06.2001\n2,01.06.2001\n3,x\n")
    for formats in ("infer", {"as_of_date": "d.M.yyyy"}, "d.M.yyyy"):
        df = read_features_csv(spark, str(path), date_formats=formats)
        rows = df.orderBy("externalcustomerkey").collect()
        assert [r.as_of_date for r in rows] == [DAY, date(2001, 6, 1), None]
    assert read_features_csv(spark, str(path)).where("as_of_date is not null").count() == 0
