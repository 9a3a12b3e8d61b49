"""Counts from one scan of each table, and the summary built on them."""

import re

from pyspark.sql import functions as F

from civicstat.operators import quality as Q
from civicstat.operators.scan import Count, Lookup, scan_once
from civicstat.plans import quality_queries as P
from tests.conftest import SF_SMALL
from tests.test_plans import plan


def counts(df):
    return {(r.kind, r.subject, r.column): r.n for r in df.collect()}


def test_counts_and_lookups(spark):
    fact = spark.createDataFrame([(1, "x", 5.0)] * 300 + [(2, None, None), (None, "y", -1.0), (9, "y", 0.0), (9, "y", 1.0)], "k int, s string, v double")
    dim = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "id long")
    other = spark.createDataFrame([(3,)], "id smallint")
    none = dim.filter("id < 0")
    got = counts(scan_once({"fact": fact, "dim": dim, "other": other, "none": none}, [
        Count("rows", "fact"), Count("rows", "none"), Count("nulls", "fact", "s", F.col("s").isNull()),
        Count("low", "fact", "v", F.col("v") <= 0),
        Lookup("orphans", "fact->dim", ("fact", "k"), [("dim", "id")]),
        Lookup("orphans", "fact->none", ("fact", "k"), [("none", "id")]),
        Lookup("orphans", "none->fact", ("none", "id"), [("fact", "k")]),
        Lookup("unused", "dim", ("dim", "id"), [("fact", "k"), ("other", "id")], distinct=True),
        Lookup("unused", "dim by fact", ("dim", "id"), [("fact", "k")], distinct=True)]))
    assert got == {("rows", "fact", None): 304, ("rows", "none", None): 0, ("nulls", "fact", "s"): 1, ("low", "fact", "v"): 2,
                   ("orphans", "fact->dim", "k"): 3, ("orphans", "fact->none", "k"): 304, ("orphans", "none->fact", "id"): 0,
                   ("unused", "dim", "id"): 1, ("unused", "dim by fact", "id"): 2}


def test_text_keys_and_no_lookup(spark):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    dim = spark.createDataFrame([(1,)], "id long")
    assert counts(scan_once({"fact": fact, "dim": dim}, [Lookup("orphans", "f", ("fact", "s"), [("dim", "id")])])) == {("orphans", "f", "s"): 3}
    assert counts(scan_once({"fact": fact}, [Count("rows", "fact")])) == {("rows", "fact", None): 3}


def test_each_table_is_scanned_once(spark):
    questions = P.asked({t: c for t, c in P.NULL_COLUMNS.items() if t != "ind"})
    tables = P.tables_of(spark, SF_SMALL, questions)
    p = plan(P.dq_scan_once(spark, SF_SMALL))
    scans = re.findall(r"^Location: \S+ \[\S*?/(\w+)\.parquet", p, re.M)
    assert sorted(scans) == sorted(tables)
    assert "SortMergeJoin" not in p and "LeftAnti" not in p


def test_summary_has_the_rows_of_the_separate_checks(spark):
    apart = Q.union_checks([f(spark, SF_SMALL) for f in (
        P.row_count_checks, P.key_set_checks, P.orphan_checks, P.truth_compare_checks, P.unused_ref_checks, P.naming_checks,
        P.null_checks, P.tolerance_rule_checks, P.total_equal_checks, P.sum_close_checks, P.spot_checks)])
    key = lambda rows: sorted((tuple(r) for r in rows), key=lambda t: tuple(map(str, t)))
    assert key(P.all_checks(spark, SF_SMALL).collect()) == key(apart.collect())
