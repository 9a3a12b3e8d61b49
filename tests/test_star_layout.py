"""The reference layout spec against a partial schema; section views; retire."""

import pytest
from pyspark.sql import functions as F

from civicstat.operators.validator import TruthSpec, report, validate
from civicstat.plans import star_layout as S

DB = "civic_layout"


@pytest.fixture(scope="module")
def layout_db(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    w = lambda df, t: df.write.mode("overwrite").saveAsTable(f"{DB}.{t}")
    keys = list(S.COMMUNITY_KEYS)
    w(spark.createDataFrame([(k, k.title(), str(100 + i)) for i, k in enumerate(keys)],
                            "geography_key string, geography string, geography_id string"), "geography_dim")
    w(spark.createDataFrame([(str(100 + i), "S1", 1000 + i, 100 + i) for i in range(7)],
                            "geography_id string, source_id string, pop_2021 long, households long"),
      "hna_demographics_csd_2021")
    w(spark.createDataFrame([(str(100 + i), "S1", "community_total", 10 + i) for i in range(7)],
                            "geography_id string, source_id string, priority_group string, chn_count long"),
      "hna_priority_groups_csd_2021")
    w(spark.createDataFrame([(str(100 + i), "S1", 10 + i + (i == 0)) for i in range(7)],
                            "geography_id string, source_id string, chn_total long"),
      "hna_housing_indicators_csd_2021")
    return DB


def test_layout_spec_on_partial_schema(spark, layout_db):
    spec = S.layout_spec(truths=[TruthSpec("5-truth-demographics", "hna_demographics_csd_2021", ["pop_2021"],
                                           {"airdrie": {"pop_2021": 1000}, "cochrane": {"pop_2021": 5}})],
                         expected_objects=None)
    checks = validate(spark, spec, layout_db)
    got = {(r.category, r.check_name): r.status for r in checks.collect()}
    assert got[("1-rowcounts", "geography_dim")] == "PASS"
    assert got[("1-rowcounts", "timeframe_dim")] == "MISSING"
    assert got[("2-dims", "geography_dim completeness")] == "PASS"
    assert got[("2-dims", "census years")] == "SKIPPED"
    assert got[("5-truth-demographics", "airdrie.pop_2021")] == "PASS"
    assert got[("5-truth-demographics", "cochrane.pop_2021")] == "FAIL"
    assert got[("6-consistency", "airdrie: priority_total=chn_total")] == "FAIL"     # 10 vs 11
    assert got[("6-consistency", "cochrane: priority_total=chn_total")] == "PASS"
    assert got[("8-spot", "smallest communities present")] == "PASS"
    assert got[("8-spot", "co-op units all 0")] == "SKIPPED"
    summary, tiers, failures = report(checks, S.VERIFIED_COMMUNITIES)
    assert summary.filter(F.col("category") == "TOTAL").first().total == checks.count()
    assert failures.filter(F.col("status") == "MISSING").count() >= 16


def test_publish_views_and_retire(spark, layout_db):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    long = spark.createDataFrame([("demographics", "Alderton", 1.0), ("rental_market", "Alderton", 2.0)],
                                 "dashboard_section string, geography string, indicator_value double")
    long.write.mode("overwrite").saveAsTable(f"{DB}.long_table")
    out = {r.object_name: r.status for r in S.publish_section_views(
        spark, f"{DB}.long_table", DB, geography_table=f"{DB}.geography_dim",
        comments={"demographics": "View | demographics"}).collect()}
    assert set(out.values()) == {"OK"} and len(out) == 9
    assert spark.table(f"{DB}.v_demographics").count() == 1
    assert spark.table(f"{DB}.v_housing_supply").count() == 0
    dry = {r.object_name.split(".")[1]: r.status for r in S.retire_star_tables(spark, DB).collect()}
    assert dry["geography_dim"] == "WOULD_DROP" and dry["timeframe_dim"] == "ABSENT"


def test_validate_cli(spark, layout_db, tmp_path, capsys):
    from civicstat.validate_cli import main
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DB}")
    truth = tmp_path / "truth.json"
    truth.write_text('[{"category": "5-truth-demographics", "table": "hna_demographics_csd_2021", '
                     '"measures": ["pop_2021"], "truth": {"airdrie": {"pop_2021": 1000}}}]')
    rc = main(["--schema", DB, "--out", str(tmp_path / "checks"), "--truth", str(truth)], spark=spark)
    assert rc == 1                                    # the partial schema has MISSING tables
    written = spark.read.parquet(str(tmp_path / "checks"))
    assert written.filter("check_name = 'airdrie.pop_2021'").count() == 1
    assert "TOTAL" in capsys.readouterr().out


def test_layout_naming_pattern(spark, layout_db):
    import re
    rx = re.compile(S.NAME_PATTERN)
    assert all(rx.match(t) for t in S.EXPECTED_ROWS)
    assert not rx.match("v_demographics") and not rx.match("long_table")
    checks = validate(spark, S.layout_spec(expected_objects=None), layout_db)
    naming = {r.subject: r.status for r in checks.filter(F.col("category") == "9-standards").collect()}
    assert naming["hna_demographics_csd_2021"] == "PASS" and naming["geography_dim"] == "PASS"
