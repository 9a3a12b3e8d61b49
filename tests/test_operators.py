"""Operator semantics on small invented fixtures (FIXTURES.md section 5 shapes)."""

import pytest
from pyspark.sql import functions as F

from civicstat.operators import longform as L
from civicstat.operators import rank
from civicstat.operators import reshape as R
from civicstat.operators import star
from tests.conftest import rows

LONG_SCHEMA = ("dashboard_section string, geography string, geography_id string, geography_type string, "
               "characteristic string, timeframe string, indicator_value double, data_source string")


@pytest.fixture(scope="module")
def long(spark):
    data = [
        ("demographics", "Alderton", "1", "CY", "Population", "2006", 100.0, "census"),
        ("demographics", "Alderton", "1", "CY", "Population", "2011", 120.0, "census"),
        ("demographics", "Alderton", "1", "CY", "Population", "Percentage of all HHs", 55.0, "census"),
        ("demographics", "Brookfield", "2", "T", "Population", "2006", 50.0, "census"),
        ("demographics", "Brookfield", "2", "T", "Population", "2011", None, "census"),   # suppressed
        ("demographics", "Cedarvale", "3", "T", "Population", "2006", 70.0, "census"),
        ("rental_market", "Alderton", "1", "CY", "Vacancy Rate - Total", "2021", 2.5, "cmhc"),
        ("rental_market", "Alderton", "1", "CY", "Vacancy Rate - Total", "2023", 1.5, "cmhc"),
        ("rental_market", "Brookfield", "2", "T", "Vacancy Rate - Total", "2022", 3.0, "cmhc"),
        ("rental_market", "Brookfield", "2", "T", "Vacancy Rate - Bachelor", "2023", 4.0, "cmhc"),
    ]
    return spark.createDataFrame(data, LONG_SCHEMA)


def test_parse_year_non_year_is_null(spark, long):
    got = rows(L.with_year(long).filter(F.col("geography") == "Alderton")
               .filter(F.col("dashboard_section") == "demographics"), "timeframe", "year")
    assert got == [("2006", 2006), ("2011", 2011), ("Percentage of all HHs", None)]


def test_any_like_does_not_duplicate(long):
    sel = L.select_indicators(long, any_like=["Vacancy%", "%Total%"])
    assert sel.count() == 4


def test_select_conjunctive(long):
    sel = L.select_indicators(long, section="demographics", characteristics=["Population"], periods=["2006"])
    assert rows(sel, "geography") == [("Alderton",), ("Brookfield",), ("Cedarvale",)]


def test_fallback_narrow_present_absent_none(long):
    narrow_present = L.fallback_select(long, [F.col("characteristic").like("%Total%"),
                                              F.col("characteristic").like("Vacancy%")])
    assert narrow_present.count() == 3
    narrow_absent = L.fallback_select(long, [F.col("characteristic").like("Nothing%"),
                                             F.col("characteristic").like("Vacancy%")])
    assert narrow_absent.count() == 4
    none = L.fallback_select(long, [F.col("characteristic").like("Nothing%")])
    assert none.count() == 0


def test_latest_per_group_by_parsed_year(long):
    """A text max would pick 'Percentage of all HHs'; parsed year picks 2011."""
    d = L.with_year(long.filter(F.col("dashboard_section") == "demographics"))
    got = rows(rank.latest_per_group(d, "geography", "year", ["indicator_value"]),
               "geography", "year", "indicator_value")
    assert got == [("Alderton", 2011, 120.0), ("Brookfield", 2011, None), ("Cedarvale", 2006, 70.0)]


def test_latest_per_group_tie_break(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", 2020, 3.0), ("a", 2019, 9.0)], "g string, y int, v double")
    assert rows(rank.latest_per_group(df, "g", "y", ["v"]), "g", "y", "v") == [("a", 2020, 3.0)]


def test_latest_global_drops_groups_without_that_year(long):
    d = L.with_year(L.select_indicators(long, like="Vacancy Rate - Total"))
    assert rows(rank.latest_global(d, "year"), "geography", "year") == [("Alderton", 2023)]


def test_top_k_ties_keep_smaller_key(spark):
    df = spark.createDataFrame([("b", 5.0), ("a", 5.0), ("c", 1.0), ("d", 5.0)], "k string, v double")
    assert [r.k for r in rank.top_k(df, "k", "v", 2).collect()] == ["a", "b"]
    assert rows(rank.keep_top_k(df, "k", "v", 2), "k") == [("a",), ("b",)]


def test_above_median_even_count_interpolates(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", 10.0)], "k string, v double")
    got = rows(rank.above_median(df, "v"), "k", "above_median")
    assert got == [("a", False), ("b", False), ("c", True), ("d", True)]   # median 2.5, strict >


def test_pivot_unique_absent_value_column_and_fill(long):
    d = L.select_indicators(long, section="demographics", characteristics=["Population"])
    wide = R.pivot_unique(d, "geography", "timeframe", "indicator_value", ["2006", "2011", "2016"])
    assert wide.columns == ["geography", "2006", "2011", "2016"]
    got = {r.geography: (r["2006"], r["2011"], r["2016"]) for r in wide.collect()}
    assert got["Brookfield"] == (50.0, None, None)
    filled = R.pivot_unique(d, "geography", "timeframe", "indicator_value", ["2006", "2011", "2016"],
                            aliases=["y06", "y11", "y16"], fill=0)
    got = {r.geography: (r.y06, r.y11, r.y16) for r in filled.collect()}
    assert got["Cedarvale"] == (70.0, 0.0, 0.0)


def test_duplicate_cells_report_and_error(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", 3.0)], "i string, c string, v double")
    assert rows(R.duplicate_cells(df, "i", "c"), "i", "c", "n_rows") == [("a", "x", 2)]
    with pytest.raises(ValueError):
        R.assert_unique_cells(df, "i", "c")


def test_pivot_latest_skips_newest_null(spark):
    df = spark.createDataFrame([("g", "rent", 2020, 900.0), ("g", "rent", 2022, None), ("g", "rent", 2021, 950.0)],
                               "geo string, c string, y int, v double")
    out = R.pivot_latest(df, "geo", "c", "v", "y", ["rent"]).first()
    assert out["rent"] == 950.0


def test_pivot_mean_and_sum(spark):
    df = spark.createDataFrame([("i", "a", 1.0), ("i", "a", 3.0), ("i", "b", 5.0)], "s string, c string, v double")
    mean = R.pivot_agg(df, "s", "c", F.avg("v"), ["a", "b", "z"], fill=0).first()
    assert (mean.a, mean.b, mean.z) == (2.0, 5.0, 0.0)
    total = R.pivot_agg(df, "s", "c", F.sum("v"), ["a", "b"]).first()
    assert (total.a, total.b) == (4.0, 5.0)


def test_stack_offsets(spark):
    df = spark.createDataFrame([("g", "a", 1.0), ("g", "b", None), ("g", "c", 4.0), ("h", "a", 2.0)],
                               "g string, c string, v double")
    got = rows(R.stack_offsets(df, "g", "c", "v"), "g", "c", "offset")
    assert got == [("g", "a", 0.0), ("g", "b", 1.0), ("g", "c", 1.0), ("h", "a", 0.0)]


def test_unpivot(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "k string, x double, y double")
    assert rows(R.unpivot(df, ["k"], ["x", "y"], "column", "actual")) == [("a", "x", 1.0), ("a", "y", 2.0)]


def test_orphans_count_null_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    assert rows(star.orphans(fact, dim, "k")) == [(None,), (9,)]


def test_key_set_diff(spark):
    a = spark.createDataFrame([(1,), (2,), (4,)], "k int")
    e = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert rows(star.key_set_diff(a, e, "k")) == [(1, "OK"), (2, "OK"), (3, "MISSING"), (4, "EXTRA")]


def test_presence_flag(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, name string")
    refs = spark.createDataFrame([(1,), (1,)], "k int")
    assert rows(star.presence_flag(dim, refs, "k"), "k", "status") == [(1, "USED"), (2, "UNUSED")]


def test_coverage_union_and_group_count(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "g string")
    b = spark.createDataFrame([("y",)], "g string")
    got = rows(star.coverage_union({"a": a, "b": b}, "g"))
    assert got == [("a", "x", 2), ("a", "y", 1), ("b", "y", 1)]


def test_union_distinct(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(star.union_distinct([a, b])) == [(1,), (2,), (3,)]


def test_pivot_values_guard(spark):
    df = spark.range(30).selectExpr("cast(id as string) as c")
    assert len(R.pivot_values(df, "c")) == 30
    with pytest.raises(ValueError):
        R.pivot_values(df, "c", max_values=10)


def test_above_median_sketch_option(spark):
    df = spark.range(1, 1002).selectExpr("cast(id as double) as v")        # median 501
    exact = {r.v for r in rank.above_median(df, "v").filter("above_median").collect()}
    approx = {r.v for r in rank.above_median(df, "v", exact=False, accuracy=100000).filter("above_median").collect()}
    assert exact == approx == {float(x) for x in range(502, 1002)}
