from pyspark.sql import functions as F

from civicstat.operators import quality as Q
from civicstat.plans.indicators import indicators
from civicstat.sources import catalog as C
from tests.conftest import SF_SMALL


def test_section_views_and_listing(spark):
    ind = indicators(spark, SF_SMALL)
    names = C.section_views(ind, ["rates", "segments"])
    assert names == {"rates": "v_rates", "segments": "v_segments"}
    assert spark.table("v_rates").select("dashboard_section").distinct().collect()[0][0] == "rates"
    listed = {r.table_name for r in C.list_tables(spark).collect()}
    assert {"v_rates", "v_segments"} <= listed
    out = C.listing(ind, "rates", ["geography", "characteristic", "timeframe"], ["geography", "timeframe"])
    assert out.columns == ["geography", "characteristic", "timeframe"]


def test_persistent_view_with_comment_and_standards(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS civic_test")
    assert C.schema_exists(spark, "civic_test")
    assert not C.schema_exists(spark, "civic")           # exact name, not a substring
    src = spark.createDataFrame([("rates", "a", 1.0), ("demand", "b", 2.0)],
                                "dashboard_section string, geography string, indicator_value double")
    src.write.mode("overwrite").saveAsTable("civic_test.long_src")
    C.register_catalog_view(spark, "civic_test.v_rates", "civic_test.long_src", section="rates",
                            comment="View | rates section")
    assert spark.table("civic_test.v_rates").count() == 1
    names = C.list_tables(spark, "civic_test").filter(F.col("is_temporary") == False)  # noqa: E712
    checks = {r.subject: r.status for r in Q.described_checks(names).collect()}
    assert checks["v_rates"] == "PASS"
    assert checks["long_src"] == "FAIL"


def test_retire_tables_dry_run_then_drop(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS civic_test")
    spark.range(3).write.mode("overwrite").saveAsTable("civic_test.old_fact")
    dry = {r.object_name: r.status for r in C.retire_tables(spark, ["civic_test.old_fact", "civic_test.none"]).collect()}
    assert dry == {"civic_test.old_fact": "WOULD_DROP", "civic_test.none": "ABSENT"}
    assert spark.catalog.tableExists("civic_test.old_fact")
    done = {r.object_name: r.status for r in C.retire_tables(spark, ["civic_test.old_fact"], dry_run=False).collect()}
    assert done == {"civic_test.old_fact": "DROPPED"}
    assert not spark.catalog.tableExists("civic_test.old_fact")


def test_existing(spark):
    spark.range(1).createOrReplaceTempView("tmp_exists")
    assert C.existing(spark, ["tmp_exists", "nope"]) == {"tmp_exists": True, "nope": False}
