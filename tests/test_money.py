from decimal import ROUND_HALF_UP, getcontext
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promolens.functions import money
from promolens.functions.expr import sql_columns

getcontext().prec = 60
LIMIT = 10**18 - 1
QUIET = settings(max_examples=15, deadline=None,
                 suppress_health_check=[HealthCheck.function_scoped_fixture])


@QUIET
@given(st.lists(st.integers(-LIMIT, LIMIT), min_size=1, max_size=40))
def test_split_sums_are_exact(spark, values):
    df = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "g int, v bigint")
    first = df.groupBy("g").agg(*sql_columns(*money.start_sum("v", "s")))
    both = first.groupBy().agg(*sql_columns(*money.merge_sum("s"))).withColumn("n", F.lit(len(values)))
    row = both.selectExpr(f"{money.total('s')} AS total", f"{money.mean_micros('s', 'n')} AS mean").first()
    exact = D(sum(values))
    assert row["total"] == exact.scaleb(-6)
    assert row["mean"] == (exact / len(values)).quantize(D(1), ROUND_HALF_UP)


@QUIET
@given(st.lists(st.tuples(st.integers(-10**17, 10**17), st.integers(1, 10**6)), min_size=1,
                max_size=30))
def test_division_rounds_half_away_from_zero(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = df.selectExpr("a", "b", f"{money.divide_half_up('a', 'b')} AS q").collect()
    for r in found:
        assert r.q == (D(r.a) / D(r.b)).quantize(D(1), ROUND_HALF_UP)


def test_nothing_added_stays_null(spark):
    df = spark.createDataFrame([(None,)], "v bigint").agg(
        *sql_columns(*money.start_sum("v", "s")), F.count("v").alias("n"))
    row = df.selectExpr(money.total("s"), money.mean_micros("s", "n")).first()
    assert tuple(row) == (None, None)


def test_sums_beyond_64_bit_totals(spark):
    df = spark.range(1000).select(F.lit(LIMIT).alias("v"))
    row = df.agg(*sql_columns(*money.start_sum("v", "s")), F.count("v").alias("n")).selectExpr(
        f"{money.total('s')} AS t", f"{money.mean_micros('s', 'n')} AS m").first()
    assert row.t == D(LIMIT * 1000).scaleb(-6) and row.m == LIMIT


def test_negative_upper_part_with_a_carry_is_not_positive(spark):
    values = [-(1 << 21), (1 << 20) + 5, -5]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    row = df.agg(*sql_columns(*money.start_sum("v", "s"))).selectExpr(
        money.is_positive("s") + " AS p", money.total("s") + " AS t").first()
    assert row.t < 0 and not row.p


@QUIET
@given(st.lists(st.integers(-2**40, 2**40), min_size=1, max_size=5))
def test_sign_of_sums(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    row = df.agg(*sql_columns(*money.start_sum("v", "s"))).selectExpr(
        money.is_positive("s") + " AS p").first()
    assert row.p == (sum(values) > 0)


@QUIET
@given(st.lists(st.tuples(st.integers(-10**18, 10**18), st.integers(1, 10**18)), min_size=1,
                max_size=20))
def test_shares_round_half_up_at_any_size(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    for r in df.where("abs(a) <= b").selectExpr(
        "a", "b", money.share_half_up("a", "b", 10**9) + " AS s"
    ).collect():
        assert r.s == (D(r.a) * 10**9 / D(r.b)).quantize(D(1), ROUND_HALF_UP)


@QUIET
@given(st.lists(st.tuples(st.integers(-10**12, 10**12), st.integers(1, 10**6)), min_size=1,
                max_size=20))
def test_quotients_of_decimals_are_exact(spark, pairs):
    rows = [(D(a).scaleb(-4), D(b).scaleb(-3)) for a, b in pairs]
    df = spark.createDataFrame(rows, "a decimal(20,4), b decimal(15,3)")
    for r in df.selectExpr("a", "b", money.quotient_micros("a", 4, "b", 3) + " AS q").collect():
        assert r.q == (r.a * 10**6 / r.b).quantize(D(1), ROUND_HALF_UP)
