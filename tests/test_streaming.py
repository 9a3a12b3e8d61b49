"""Streaming re-runs of the batch operators on a long table landing as files."""

import tempfile

from pyspark.sql import functions as F

from civicstat.operators import quality as Q
from civicstat.plans.indicators import indicators
from civicstat.streaming import long_table_stream, running_coverage, validate_batches
from tests.conftest import SF_SMALL


def test_checks_per_batch_and_running_coverage(spark):
    ind = indicators(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="civicstat-stream-src-")
    sink = tempfile.mkdtemp(prefix="civicstat-stream-sink-") + "/checks"
    for section in ("rates", "segments"):
        ind.filter(F.col("dashboard_section") == section).coalesce(1).write.mode("append").parquet(src)
    stream = long_table_stream(spark, src, ind.schema, max_files_per_trigger=1)

    def nulls(batch):
        return Q.null_checks({"ind": (batch, ["geography_id", "indicator_value"])})

    q = validate_batches(stream, nulls, sink, "ind_nulls")
    q.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.select("batch_id").distinct().count() == 2
    assert {r.status for r in out.collect()} == {"PASS"}

    q2 = running_coverage(long_table_stream(spark, src, ind.schema), "coverage_now", name="cov")
    q2.awaitTermination(120)
    cov = spark.table("coverage_now")
    expected = ind.filter(F.col("dashboard_section").isin("rates", "segments")).count()
    assert cov.agg(F.sum("rows")).first()[0] == expected


def test_running_coverage_to_parquet(spark):
    ind = indicators(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="civicstat-stream-src-")
    out = tempfile.mkdtemp(prefix="civicstat-stream-cov-") + "/coverage"
    ind.filter(F.col("dashboard_section") == "rates").coalesce(1).write.parquet(src + "/part1")
    q = running_coverage(long_table_stream(spark, src + "/part1", ind.schema), "cov_parquet", name="cov_parquet",
                         sink_path=out)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.agg(F.sum("rows")).first()[0] == ind.filter(F.col("dashboard_section") == "rates").count()
