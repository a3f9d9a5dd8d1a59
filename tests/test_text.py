import pytest

from promolens.sources import sinks
from promolens.sources.text import EMPTY_ONLY, normalize_missing, read_features_csv

HEADER = "externalcustomerkey,as_of_date,orders_12m,aov_net_12m_eur,country,bonus,remark\n"


def write(tmp_path, *lines):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + "\n".join(lines) + "\n")
    return str(path)


def test_types_come_from_the_contract_and_tokens_become_null(spark, tmp_path):
    path = write(
        tmp_path,
        '1,2024-03-31,3.0,1.5,NA,2,"a ""b"", c"',
        "2,not a day,,NaN,null,,x",
        "3,2024-03-31 10:00:00,4,inf,DE,1e3,None",
    )
    df = read_features_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema] == [
        "bigint", "date", "bigint", "double", "string", "double", "string"
    ]
    rows = [tuple(r) for r in df.orderBy("externalcustomerkey").collect()]
    assert rows[0][2:] == (3, 1.5, None, 2.0, 'a "b", c')
    assert rows[1] == (2, None, None, None, None, None, "x")
    assert str(rows[2][1]) == "2024-03-31" and rows[2][3:] == (float("inf"), "DE", 1000.0, None)


def test_safe_tokens_keep_the_country_na(spark, tmp_path):
    path = write(tmp_path, "1,2024-03-31,3,1.5,NA,2,x")
    assert read_features_csv(spark, path, missing=EMPTY_ONLY).first().country == "NA"


@pytest.mark.parametrize("bad", ["many", "2.5"])
def test_bad_numbers_raise_or_become_null(spark, tmp_path, bad):
    path = write(tmp_path, f"1,2024-03-31,{bad},1.5,DE,2,x")
    with pytest.raises(Exception, match="orders_12m"):
        read_features_csv(spark, path).collect()
    assert read_features_csv(spark, path, on_bad="null").first().orders_12m is None


def test_csv_writes_null_as_an_empty_field(spark, tmp_path):
    out = tmp_path / "out"
    df = spark.createDataFrame([(1, None)], "externalcustomerkey bigint, segment string")
    sinks.write_csv(df.coalesce(1), str(out))
    text = "".join(p.read_text() for p in out.glob("part-*"))
    assert text == "externalcustomerkey,segment\n1,\n"


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "nan"), (1.0, "b")], "a double, b string")
    assert [tuple(r) for r in normalize_missing(df, ["nan"]).collect()] == [(None, None), (1.0, "b")]


def test_written_feature_files_are_sorted_by_customer(spark, tmp_path):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as externalcustomerkey")
    path = str(tmp_path / "table")
    sinks.write_feature_table(df.repartition(3, "externalcustomerkey"), path)
    for file in (tmp_path / "table").glob("part-*"):
        keys = [r[0] for r in spark.read.parquet(str(file)).coalesce(1).collect()]
        assert keys == sorted(keys)


def test_bucketed_table_joins_without_a_shuffle(spark):
    df = spark.range(100).withColumnRenamed("id", "externalcustomerkey")
    sinks.save_feature_table(df, "bucketed_features", buckets=4)
    table = spark.table("bucketed_features")
    joined = table.hint("merge").join(table.alias("b"), "externalcustomerkey")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("BroadcastExchange", "") and joined.count() == 100
    spark.sql("DROP TABLE bucketed_features")


def test_text_keys_truth_values_and_line_breaks(spark, tmp_path):
    path = write(tmp_path, 'C-1,2024-03-31,3,1.5,DE,True,"two\nlines"', "C-2,2024-03-31,4,2,AT,false,x")
    df = read_features_csv(spark, path, key_type="string", multi_line=True)
    assert dict(df.dtypes)["externalcustomerkey"] == "string"
    assert dict(df.dtypes)["bonus"] == "boolean"
    rows = sorted(map(tuple, df.select("externalcustomerkey", "bonus", "remark").collect()))
    assert rows == [("C-1", True, "two\nlines"), ("C-2", False, "x")]
