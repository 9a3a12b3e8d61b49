"""Validate a catalog schema against the star-schema layout.

    spark-submit -m civicstat.validate_cli --schema cat.schema [--out /shared/checks] [--truth truth.json]
    python -m civicstat.validate_cli --schema cat.schema

Runs every check category as Spark jobs, prints the per-category summary
and the failing checks (both small), and optionally writes all check rows
as parquet.  ``--truth`` takes a JSON file
``[{"category": ..., "table": ..., "measures": [...], "truth": {...}, "period": null}]``.
Exit status 1 when any check is FAIL or MISSING.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from civicstat.operators.validator import TruthSpec, report, validate
from civicstat.plans.star_layout import VERIFIED_COMMUNITIES, layout_spec


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--schema", required=True)
    ap.add_argument("--out", help="parquet folder for all check rows")
    ap.add_argument("--truth", help="JSON list of truth specs")
    ap.add_argument("--objects", type=int, default=None, help="expected number of objects in the schema")
    a = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("civicstat-validate").getOrCreate()
    truths = []
    if a.truth:
        with open(a.truth) as fh:
            for t in json.load(fh):
                truths.append(TruthSpec(t["category"], t["table"], tuple(t["measures"]), t["truth"], t.get("period")))
    checks = validate(spark, layout_spec(truths, expected_objects=a.objects), a.schema)
    if a.out:
        checks.write.mode("overwrite").parquet(a.out)
        checks = spark.read.parquet(a.out)      # summarise what was written, no recomputation
    summary, tiers, failures = report(checks, VERIFIED_COMMUNITIES)
    summary.orderBy("is_total", "category").show(100, truncate=False)
    tiers.orderBy("tier", "status").show(100, truncate=False)
    failures.select("category", "check_name", "status", "detail").show(200, truncate=60)
    bad = failures.filter(F.col("status").isin("FAIL", "MISSING")).limit(1).count()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
