import math

import pytest
from pyspark.sql import functions as F

from civicstat.functions import labels as LB
from civicstat.functions import numeric as N


def one(spark, expr, value=None, schema="v string"):
    df = spark.createDataFrame([(value,)], schema)
    return df.select(expr.alias("r")).first()["r"]


def test_category_ordinal_unknown_is_null(spark):
    df = spark.createDataFrame([("low",), ("high",), ("extreme",), (None,)], "t string")
    got = {r.t: r.o for r in df.select("t", LB.category_ordinal("t", LB.INCOME_TIER_ORDER).alias("o")).collect()}
    assert got == {"low": 2, "high": 5, "extreme": None, None: None}


def test_unknown_label_sorts_first_like_case_without_else(spark):
    df = spark.createDataFrame([("median",), ("other",), ("very_low",)], "t string")
    order = [r.t for r in df.orderBy(LB.category_ordinal("t", LB.INCOME_TIER_ORDER)).collect()]
    assert order == ["other", "very_low", "median"]


def test_first_token_and_out_of_range(spark):
    assert one(spark, LB.first_token(F.col("v")), "Alderton, Town") == "Alderton"
    assert one(spark, F.get(F.split(F.col("v"), ","), 3), "a,b") is None


def test_case_like_falls_back(spark):
    expr = LB.case_like("v", [("%Rocky%", "Rocky")], LB.first_token(F.col("v")))
    assert one(spark, expr, "Rocky Ridge County, MD") == "Rocky"
    assert one(spark, expr, "Brookfield, City") == "Brookfield"


def test_strip_literals_all_occurrences_in_order(spark):
    expr = LB.strip_literals("v", ["Dwelling: ", " (number)"])
    assert one(spark, expr, "Dwelling: Single (number) Dwelling: x") == "Single x"


def test_map_with_fallback(spark):
    m = {"23 Construction": "Construction"}
    assert one(spark, LB.map_with_fallback("v", m), "23 Construction") == "Construction"
    assert one(spark, LB.map_with_fallback("v", m), "99 Other") == "99 Other"


def test_number_texts(spark):
    assert one(spark, LB.number_text(F.col("v"), 0), 1234567.4, "v double") == "1,234,567"
    assert one(spark, LB.currency_text(F.col("v")), 418400.0, "v double") == "$418,400"
    assert one(spark, LB.percent_text(F.col("v")), 7.74, "v double") == "7.7%"


@pytest.mark.parametrize("text,expected", [
    ("abc", None), (" 7 ", 7.0), ("NaN", None), ("1d", None), ("1_000", None),
    ("5.9", 5.9), ("-1e3", -1000.0), (None, None), ("", None)])
def test_lenient_double(spark, text, expected):
    assert one(spark, N.lenient_double("v"), text) == expected


@pytest.mark.parametrize("actual,expected,ok", [
    ("5.9", 5.0, True),          # integral expectation: truncation
    ("6.0", 5.0, False),
    ("20.75", 20.6, True),       # float noise at the bound: 0.1499...
    ("20.6", 20.75, True),
    ("1.16", 1.01, abs(1.16 - 1.01) < 0.15),   # 0.1499999... in binary: passes
    ("1.17", 1.01, False),                     # 0.16
    ("1.1499", 1.0001, True),                  # 0.1498
    ("NaN", 5.0, False), ("abc", 5.0, False), (None, 5.0, False), (" 7 ", 7, True),
])
def test_tolerance_rules(spark, actual, expected, ok):
    df = spark.createDataFrame([(actual, float(expected))], "a string, e double")
    assert df.select(N.tolerance_pass("a", "e").alias("r")).first()["r"] is ok


def test_tolerance_strict_bound(spark):
    df = spark.createDataFrame([(10.15, 10.3), (10.16, 10.3), (10.1501, 10.3)], "a double, e double")
    got = [r.r for r in df.select(N.tolerance_pass("a", "e").alias("r")).collect()]
    # |10.15-10.3| = 0.15000000000000036 (not < .15); .14 passes; .1499 passes
    assert got == [abs(10.15 - 10.3) < 0.15, True, True]


def test_nan_double_actual_fails_not_raises(spark):
    df = spark.createDataFrame([(float("nan"), 5.0)], "a double, e double")
    assert df.select(N.tolerance_pass("a", "e").alias("r")).first()["r"] is False


def test_within_bound(spark):
    df = spark.createDataFrame([(26300.0, 26290.0), (26301.0, 26290.0)], "a double, b double")
    assert [r.r for r in df.select(N.within("a", "b", 10).alias("r")).collect()] == [True, False]


@pytest.mark.parametrize("part,whole,expected", [
    (1, 8, 12.5), (1, 3, 33.3), (2, 3, 66.7), (1, 16, 6.3), (0, 5, 0.0), (5, 5, 100.0), (1, 0, None),
    (1, 80, 1.3), (123456789, 1000000000, 12.3)])
def test_pct_half_up_exact(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "p long, w long")
    assert df.select(N.pct_half_up("p", "w").alias("r")).first()["r"] == expected


def test_truncate_toward_zero(spark):
    df = spark.createDataFrame([(5.9,), (-5.9,), (float("nan"),)], "v double")
    assert [r.r for r in df.select(N.truncate("v").alias("r")).collect()] == [5, -5, None]


def test_clean_geography_name(spark):
    assert one(spark, LB.clean_geography_name("v"), "Alderton CY (9900001) 00000 (  1.8%)") == "Alderton CY"
    assert one(spark, LB.clean_geography_name("v"), "Brookfield, Town") == "Brookfield"
    assert math.isnan(float("nan"))
