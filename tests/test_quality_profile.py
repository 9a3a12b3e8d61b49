"""Validator and profile operators, incl. the negative fixtures of SURVEY section 5."""

import pytest
from pyspark.sql import functions as F

from civicstat.operators import profile as P
from civicstat.operators import quality as Q
from civicstat.sources.expected import truth_frame, expected_counts
from tests.conftest import rows


def status_of(df, name):
    return {r.check_name: r.status for r in df.collect()}[name]


def test_row_counts_missing_table(spark):
    actual = Q.table_counts({"geo": spark.range(7), "facts": spark.range(3)})
    expected = expected_counts(spark, {"geo": 7, "facts": 4, "absent": 5})
    got = {r.check_name: (r.status, r.detail) for r in Q.row_count_checks(actual, expected).collect()}
    assert got == {"geo": ("PASS", None), "facts": ("FAIL", "actual=3 expected=4"),
                   "absent": ("MISSING", "table not found")}


def test_truth_checks_missing_null_nan_and_tolerance(spark):
    # invented communities; 'Dunmore' expected but absent, Brookfield value NULL
    truth = truth_frame(spark, {
        "alderton": {"pop": 73795, "growth_pct": 20.6, "rate": 5.0},
        "brookfield": {"pop": 100},
        "dunmore": {"pop": 1},
    })
    actual = spark.createDataFrame(
        [("alderton", "73795", "20.75", "5.9"), ("brookfield", None, "1", "x")],
        "key string, pop string, growth_pct string, rate string")
    out = Q.truth_checks(actual, truth, "key", ["pop", "growth_pct", "rate"], "5-truth")
    got = {r.check_name: r.status for r in out.collect()}
    assert got == {"alderton.pop": "PASS", "alderton.growth_pct": "PASS", "alderton.rate": "PASS",
                   "brookfield.pop": "FAIL", "dunmore.pop": "MISSING"}


def test_truth_checks_with_period(spark):
    truth = truth_frame(spark, {"a": {"2016": {"ei": 1361}, "2017": {"ei": 1265}}}, nested_period=True)
    actual = spark.createDataFrame([("a", 2016, 1361.4)], "g string, y int, ei double")
    out = Q.truth_checks(actual, truth, "g", ["ei"], "5-truth-ei", period="y")
    assert {r.check_name: r.status for r in out.collect()} == {"a.2016.ei": "PASS", "a.2017.ei": "MISSING"}


def test_equal_totals_negative_fixture(spark):
    # owner 360 + renter 445 = 805 vs chn_total 800 -> FAIL; 955 + 1035 = 1990 -> PASS
    left = spark.createDataFrame([("cedarvale", 805.0), ("alderton", 1990.0), ("solo", 1.0)], "k string, value double")
    right = spark.createDataFrame([("cedarvale", 800.0), ("alderton", 1990.0)], "k string, value double")
    got = {r.subject: r.status for r in Q.equal_totals_check(left, right, "k", "total").collect()}
    assert got == {"cedarvale": "FAIL", "alderton": "PASS", "solo": "MISSING"}


def test_sum_close_bound_10_and_11(spark):
    parts = spark.createDataFrame([("a", 26000.0), ("a", 300.0), ("b", 12111.0)], "k string, value double")
    whole = spark.createDataFrame([("a", 26290.0), ("b", 12100.0)], "k string, value double")
    got = {r.subject: r.status for r in Q.sum_close_check(parts, whole, "k", "sum").collect()}
    assert got == {"a": "PASS", "b": "FAIL"}


def test_null_checks_empty_table_gives_zero(spark):
    empty = spark.createDataFrame([], "geography_id string, source_id string")
    some = spark.createDataFrame([("1", None), (None, None)], "geography_id string, source_id string")
    out = Q.null_checks({"empty": (empty, ["geography_id"]), "some": (some, ["geography_id", "source_id"])})
    got = {r.check_name: (r.status, r.actual) for r in out.collect()}
    assert got == {"empty.geography_id": ("PASS", 0.0), "some.geography_id": ("FAIL", 1.0),
                   "some.source_id": ("FAIL", 2.0)}


def test_orphans_and_unused(spark):
    fact = spark.createDataFrame([("1",), ("9",), (None,)], "geography_id string")
    dim = spark.createDataFrame([("1",), ("2",)], "geography_id string")
    o = Q.orphan_checks([("fact", fact, "geography_id", "dim", dim, "geography_id")])
    r = o.first()
    assert (r.status, r.actual, r.detail) == ("FAIL", 2.0, "2 orphan rows")
    u = Q.unused_refs_check(dim, [fact], "geography_id", "sources used").first()
    assert (u.status, u.actual) == ("FAIL", 1.0)


def test_key_set_check(spark):
    a = spark.createDataFrame([(2006,), (2011,), (2016,)], "y int")
    e = spark.createDataFrame([(2006,), (2011,), (2016,), (2021,)], "y int")
    r = Q.key_set_check(a, e, "y", "census years").first()
    assert (r.status, r.detail) == ("FAIL", "missing=1 extra=0")


def test_spot_expect_rows(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert Q.expect_rows(df.filter("x > 5"), "empty", maximum=0).first().status == "PASS"
    assert Q.expect_rows(df.filter("x > 5"), "present", minimum=1).first().status == "FAIL"


def test_naming_and_comments(spark):
    names = spark.createDataFrame([("hna_demographics_csd_2021", "View | x"), ("BadName", None)],
                                  "table_name string, description string")
    n = {r.subject: r.status for r in Q.naming_checks(names, r"^[a-z]+(_[a-z0-9]+)*$").collect()}
    assert n == {"hna_demographics_csd_2021": "PASS", "BadName": "FAIL"}
    c = {r.subject: r.status for r in Q.described_checks(names).collect()}
    assert c == {"hna_demographics_csd_2021": "PASS", "BadName": "FAIL"}


def test_summary_rollup_and_disjoint_tiers(spark):
    checks = spark.createDataFrame([
        ("1-rowcounts", "t", None, None, "PASS", 1.0, 1.0, 0.0, None),
        ("5-truth", "alderton.pop", "alderton", "pop", "FAIL", 1.0, 2.0, 1.0, None),
        ("5-truth", "brookfield.pop", "brookfield", "pop", "PASS", 1.0, 1.0, 0.0, None),
        ("5-truth", "dunmore.pop", "dunmore", "pop", "MISSING", None, 1.0, None, None),
    ], Q.CHECK_SCHEMA)
    s = {r.category: (r.total, r.passed, r.failed, r.missing) for r in Q.summarize(checks).collect()}
    assert s == {"1-rowcounts": (1, 1, 0, 0), "5-truth": (3, 1, 1, 1), "TOTAL": (4, 2, 1, 1)}
    t = rows(Q.confidence_tiers(checks, ["alderton"]))
    assert t == [("structural", "PASS", 1), ("unverified", "MISSING", 1), ("unverified", "PASS", 1),
                 ("verified", "FAIL", 1)]
    assert sum(x[2] for x in t) == 4   # tiers are disjoint


LONG_SCHEMA = ("dashboard_section string, geography string, geography_id string, geography_type string, "
               "characteristic string, timeframe string, indicator_value double, data_source string")


@pytest.fixture(scope="module")
def long(spark):
    data = [
        ("demographics", "Alderton", "1", "CY", "Population", "2006", 100.0, "c"),
        ("demographics", "Alderton", "1", "CY", "Population", "2011", 120.0, "c"),
        ("demographics", "Alderton", "1", "CY", "Households", "Percentage of all HHs", 55.0, "c"),
        ("demographics", "Brookfield", "2", "T", "Population", "2006", None, "c"),
        ("rental_market", "Alderton", "1", "CY", "Rent", "2022", 1.0, "h"),
        ("rental_market", "Alderton", "1", "CY", "Rent", "2023", 1.0, "h"),
        ("rental_market", "Cedarvale", "3", "T", "Rent", "2022", 1.0, "h"),
    ]
    return spark.createDataFrame(data, LONG_SCHEMA)


def test_completeness_text_max_vs_parsed_year(long):
    p = {r.dashboard_section: r for r in P.completeness_profile(long).collect()}
    demo = p["demographics"]
    assert demo.latest_period == "Percentage of all HHs"     # lexicographic (the reference's bug)
    assert demo.latest_year == 2011                          # parsed
    assert (demo.total_rows, demo.null_values, demo.pct_complete) == (4, 1, 75.0)


def test_completeness_rollup_total(long):
    r = {x.dashboard_section: x for x in P.completeness_rollup(long).collect()}
    assert r["TOTAL"].total_rows == 7 and r["TOTAL"].is_total
    assert r["TOTAL"].communities == 3


def test_section_profile(long):
    got = rows(P.section_profile(long))
    assert got == [("demographics", 4, 2, 2, 3), ("rental_market", 3, 2, 1, 2)]


@pytest.fixture(scope="module")
def geo(spark):
    return spark.createDataFrame([("Alderton",), ("Brookfield",), ("Cedarvale",)], "geography string")


def test_missing_periods_and_coverage(long, geo):
    miss = rows(P.missing_periods(long, geo, ["rental_market"], [2022, 2023]))
    assert miss == [("rental_market", "Brookfield", 2022), ("rental_market", "Brookfield", 2023),
                    ("rental_market", "Cedarvale", 2023)]
    m = rows(P.coverage_matrix(long, geo, ["rental_market"]), "geography", "rows")
    assert m == [("Alderton", 2), ("Brookfield", 0), ("Cedarvale", 1)]
    s = P.coverage_summary(P.coverage_matrix(long, geo, ["rental_market"])).first()
    assert (s.covered, s.total, s.uncovered) == (2, 3, 1)


def test_depth_stale_bad_periods(long, geo):
    d = {(r.geography, r.characteristic): (r.periods, r.depth)
         for r in P.depth(long, geo, "rental_market", good=2).collect()}
    assert d == {("Alderton", "Rent"): (2, "good"), ("Brookfield", "Rent"): (0, "missing"),
                 ("Cedarvale", "Rent"): (1, "sparse")}
    st = rows(P.stale_series(long), "geography", "characteristic", "last_year", "peer_last_year")
    assert st == [("Brookfield", "Population", 2006, 2011), ("Cedarvale", "Rent", 2022, 2023)]
    assert rows(P.bad_periods(long)) == [("demographics", "Percentage of all HHs", 1)]


def test_missing_characteristics_and_elsewhere(spark, long):
    exp = spark.createDataFrame([("demographics", "Population"), ("demographics", "Commuter flow")],
                                "dashboard_section string, characteristic string")
    assert rows(P.missing_characteristics(long, exp)) == [("demographics", "Commuter flow")]
    assert rows(P.available_elsewhere(long, "rental_market", "demographics")) == [
        ("rental_market", "demographics", "Brookfield")]


def test_name_drift_unknown_decorated(spark):
    src = spark.createDataFrame([("1", "Alderton CY (9900001) 00000 (  1.8%)"), ("2", "Unknown"),
                                 ("3", "Cedarvale"), ("9", "Nowhere (X)")], "geography_id string, geography string")
    dim = spark.createDataFrame([("1", "Alderton"), ("2", "Brookfield"), ("3", "Cedarvale")],
                                "geography_id string, geography string")
    got = {r.geography_id: (r.drift, r.standard_name) for r in P.name_drift(src, dim).collect()}
    assert got == {"1": ("decorated", "Alderton"), "2": ("unknown", "Brookfield"), "9": ("unknown id", "Nowhere")}


def test_density_and_scope_share(spark, long):
    d = {r.dashboard_section: r for r in P.density(long).collect()}
    assert d["demographics"].expected_cells == 2 * 2 * 3
    docs = spark.createDataFrame([("s", True), ("s", False), ("t", False)], "src string, ok boolean")
    got = rows(P.scope_share(docs, "src", F.col("ok")))
    assert got == [("s", 2, 1, 50.0), ("t", 1, 0, 0.0)]


def test_write_with_checks_one_pass(spark, tmp_path):
    df = spark.createDataFrame([("1", "a"), ("2", None), (None, None)], "geography_id string, source_id string")
    out = Q.write_with_checks(df, str(tmp_path / "fact"), "fact", ["geography_id", "source_id"], expected_rows=3)
    got = {r.check_name: (r.status, r.actual) for r in out.collect()}
    assert got == {"fact": ("PASS", 3.0), "fact.geography_id": ("FAIL", 1.0), "fact.source_id": ("FAIL", 2.0)}
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 3


def test_approx_profile_runs(long):
    got = {r.dashboard_section: r.communities for r in P.section_profile(long, approx=True).collect()}
    assert got == {"demographics": 2, "rental_market": 2}


def test_all_null_measure(spark):
    from civicstat.operators import rank, reshape as R
    df = spark.createDataFrame([("s", "A", "1", "T", "c", "2020", None, "x"), ("s", "B", "2", "T", "c", "2021", None, "x")],
                               LONG_SCHEMA)
    p = P.completeness_profile(df).first()
    assert (p.total_rows, p.null_values, p.pct_complete) == (2, 2, 0.0)
    wide = R.pivot_unique(df, "geography", "timeframe", "indicator_value", ["2020", "2021"])
    assert {(r["2020"], r["2021"]) for r in wide.collect()} == {(None, None)}
    assert R.pivot_latest(df, "geography", "characteristic", "indicator_value", "timeframe", ["c"]).count() == 0
    latest = rank.latest_per_group(df.withColumn("year", F.col("timeframe").cast("int")), "geography", "year",
                                   ["indicator_value"])
    assert {r.indicator_value for r in latest.collect()} == {None}


def test_key_set_check_takes_null_as_a_key(spark):
    a = spark.createDataFrame([(1,), (None,), (None,)], "y int")
    same = Q.key_set_check(a, spark.createDataFrame([(None,), (1,)], "y int"), "y", "k").first()
    assert (same.status, same.actual, same.expected) == ("PASS", 2.0, 2.0)
    r = Q.key_set_check(a, spark.createDataFrame([(1,), (2,)], "y int"), "y", "k").first()
    assert (r.status, r.detail) == ("FAIL", "missing=1 extra=1")


def test_orphans_of_all_pairs_from_one_scan_a_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = [(1, 10, "a")] * 500 + [(2, 11, "b"), (None, 12, None), (3, 99, "zz")]
    spark.createDataFrame(rows, "k1 int, k2 long, s string").repartition(4).write.parquet(path)
    fact = spark.read.parquet(path)
    d1 = spark.createDataFrame([(1,), (2,), (2,)], "id long")
    d2 = spark.createDataFrame([(10,), (11,), (12,)], "id int")
    empty = d2.filter("id < 0")
    pairs = [("fact", fact, "k1", "d1", d1, "id"), ("fact", fact, "k2", "d2", d2, "id"), ("d1", d1, "id", "fact", fact, "k1"), ("empty", empty, "id", "d1", d1, "id"), ("d2", d2, "id", "empty", empty, "id")]
    got = Q.orphan_checks_one_scan(pairs)
    assert {(r.check_name, r.column): (r.status, r.actual) for r in got.collect()} == {
        ("fact->d1", "k1"): ("FAIL", 2.0), ("fact->d2", "k2"): ("FAIL", 1.0), ("d1->fact", "id"): ("PASS", 0.0), ("empty->d1", "id"): ("PASS", 0.0), ("d2->empty", "id"): ("FAIL", 3.0)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    text = Q.orphan_checks_one_scan([("fact", fact, "s", "d", spark.createDataFrame([("a",), ("b",)], "s string"), "s")]).first()
    assert text.actual == 2.0


def test_sum_close_check_keeps_null_keys(spark):
    parts = spark.createDataFrame([("a", None, 3.0), ("a", None, 4.0), (None, "1", 1.0)], "g string, t string, value double")
    whole = spark.createDataFrame([("a", None, 8.0), (None, "1", 50.0)], "g string, t string, value double")
    got = {r.subject: r.status for r in Q.sum_close_check(parts, whole, ["g", "t"], "n", bound=10).collect()}
    assert got == {"a|NULL": "PASS", "NULL|1": "FAIL"}
