"""Spec-driven star-schema validation on an invented three-community schema."""

import pytest
from pyspark.sql import functions as F

from civicstat.operators.validator import (SpotSpec, StarSchemaSpec, SumCloseSpec, TotalEqualSpec, TruthSpec,
                                           report, validate)

DB = "civic_star"


@pytest.fixture(scope="module")
def schema(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    w = lambda df, t: df.write.mode("overwrite").saveAsTable(f"{DB}.{t}")
    w(spark.createDataFrame([("alderton", "Alderton", "11"), ("brookfield", "Brookfield", "12"),
                             ("cedarvale", "Cedarvale", "13")], "geography_key string, geography string, geography_id string"),
      "geography_dim")
    w(spark.createDataFrame([(2016, True), (2021, True), (2022, False)], "timeframe_id int, is_census_year boolean"),
      "timeframe_dim")
    w(spark.createDataFrame([("S1", "StatCo"), ("S2", "Other"), ("S3", "Unused")], "source_id string, source_name string"),
      "source_dim")
    w(spark.createDataFrame([("11", "S1", 100.0, 40), ("12", "S1", 50.0, 20), ("13", "S2", None, 10)],
                            "geography_id string, source_id string, pop_2021 double, households bigint"),
      "demo_facts")
    w(spark.createDataFrame([("11", "S1", "low", 15), ("11", "S1", "high", 26), ("12", "S2", "low", 31),
                             ("99", None, "low", 1)],
                            "geography_id string, source_id string, income_tier string, household_count bigint"),
      "income_facts")
    w(spark.createDataFrame([("11", "S1", 2016, 5), ("11", "S1", 2023, 6), ("12", "S1", 2021, 7)],
                            "geography_id string, source_id string, timeframe_id int, recipient_count bigint"),
      "ei_facts")
    return DB


def spec(**kw):
    base = dict(
        expected_rows={"geography_dim": 3, "timeframe_dim": 3, "source_dim": 3, "demo_facts": 3,
                       "income_facts": 3, "ei_facts": 3, "gone_facts": 7},
        geo_facts=("demo_facts", "income_facts", "ei_facts", "gone_facts"),
        timeframe_facts=("ei_facts",),
        expected_geo_keys=("alderton", "brookfield", "cedarvale", "dunmore"),
        expected_census_years=(2016, 2021),
        expected_sources=3,
        truths=(TruthSpec("5-truth-demo", "demo_facts", ("pop_2021",),
                          {"alderton": {"pop_2021": 100}, "cedarvale": {"pop_2021": 70}, "dunmore": {"pop_2021": 1}}),
                TruthSpec("5-truth-ei", "ei_facts", ("recipient_count",),
                          {"alderton": {"2016": {"recipient_count": 5}, "2017": {"recipient_count": 9}}},
                          period="timeframe_id")),
        total_equal=(TotalEqualSpec("low tier = households", "income_facts", "household_count", "demo_facts",
                                    "households", left_filter="income_tier = 'low'"),),
        sum_close=(SumCloseSpec("tiers ~= households", "income_facts", "household_count", "demo_facts", "households"),),
        spots=(SpotSpec("cedarvale pop suppressed", "demo_facts", "geography_key = 'cedarvale' AND pop_2021 IS NULL",
                        minimum=1),),
        expected_objects=6,
    )
    base.update(kw)
    return StarSchemaSpec(**base)


def test_validate_statuses(spark, schema):
    checks = validate(spark, spec(), schema)
    got = {(r.category, r.check_name): r.status for r in checks.collect()}
    assert got[("1-rowcounts", "income_facts")] == "FAIL"                 # 4 rows vs 3
    assert got[("1-rowcounts", "gone_facts")] == "MISSING"
    assert got[("2-dims", "geography_dim completeness")] == "FAIL"        # dunmore missing
    assert got[("2-dims", "census years")] == "PASS"
    assert got[("3-fk", "income_facts->geography_dim")] == "FAIL"          # '99'
    assert got[("3-fk", "ei_facts->timeframe_dim")] == "FAIL"              # 2023
    assert got[("3-fk", "gone_facts->geography_dim")] == "SKIPPED"
    assert got[("4-nulls", "income_facts.source_id")] == "FAIL"
    assert got[("5-truth-demo", "alderton.pop_2021")] == "PASS"
    assert got[("5-truth-demo", "cedarvale.pop_2021")] == "FAIL"           # NULL actual
    assert got[("5-truth-demo", "dunmore.pop_2021")] == "MISSING"
    assert got[("5-truth-ei", "alderton.2016.recipient_count")] == "PASS"
    assert got[("5-truth-ei", "alderton.2017.recipient_count")] == "MISSING"
    assert got[("6-consistency", "alderton: low tier = households")] == "FAIL"   # 15 vs 40
    assert got[("6-consistency", "brookfield: tiers ~= households")] == "FAIL"    # 31 vs 20
    assert got[("7-traceability", "all sources referenced")] == "FAIL"            # S3 unused
    assert got[("8-spot", "cedarvale pop suppressed")] == "PASS"
    assert got[("9-standards", "object count")] == "PASS"


def test_dropped_schema_does_not_pass_vacuously(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS civic_empty")
    checks = validate(spark, spec(), "civic_empty")
    statuses = {r.status for r in checks.collect()}
    assert "PASS" not in statuses
    assert checks.filter(F.col("status").isin("MISSING", "SKIPPED")).count() >= 7 + 4
    summary, tiers, failures = report(checks)
    total = summary.filter("category = 'TOTAL'").first()
    assert total.passed == 0 and total.total == checks.count()
