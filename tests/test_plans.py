"""Plan-shape assertions: the physical plans we want at scale."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def q():
    return E.queries()


def test_orphans_use_anti_join(spark, q):
    p = plan(q["dq_orphans"](spark, SF_SMALL))
    assert "LeftAnti" in p


def test_dimension_join_is_broadcast_after_size_check(spark, q):
    p = plan(q["star_enrich_rename"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_latest_is_an_aggregate_not_a_window(spark, q):
    for name in ("latest_per_group", "latest_per_two_keys", "latest_event_per_user"):
        p = plan(q[name](spark, SF_SMALL))
        assert "Window" not in p, name
        assert "partial_max" in p, name      # map-side combine before the shuffle


def test_global_max_and_median_are_scalar_subqueries(spark, q):
    for name in ("latest_global", "avg_above_median", "fallback_hit"):
        p = plan(q[name](spark, SF_SMALL))
        assert "Window" not in p, name
        assert "Subquery" in p, name


def test_windows_are_partitioned(spark, q):
    p = plan(q["stack_offsets"](spark, SF_SMALL))
    windows = [l for l in p.splitlines() if l.startswith("Arguments:") and "windowspecdefinition" in l]
    assert windows
    # every window spec has partition keys (an unpartitioned window would move all rows to one task)
    assert all("windowspecdefinition(geography" in l for l in windows)


def test_filters_reach_the_scan(spark, q):
    p = plan(q["star_multi_predicate"](spark, SF_SMALL))
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")]
    joined = " ".join(pushed)
    assert "EqualTo(o_orderstatus,F)" in joined
    assert "GreaterThan(o_totalprice,100000" in joined


def test_scan_reads_only_needed_columns(spark, q):
    p = plan(q["pivot_sum_fill"](spark, SF_SMALL))
    schema = [l for l in p.splitlines() if l.startswith("ReadSchema")][0]
    assert set(re.findall(r"(\w+):", schema.split(":", 1)[1])) == {"l_quantity", "l_returnflag", "l_linestatus"}


def test_fact_is_aggregated_before_joining(spark, q):
    """table_coverage_union reduces lineitem to per-supplier counts before the join."""
    p = plan(q["table_coverage_union"](spark, SF_SMALL))
    assert p.count("partial_count") >= 2


def test_section_filter_prunes_union_branches(spark, q):
    full = plan(q["section_profile"](spark, SF_SMALL))
    one = plan(q["section_listing"](spark, SF_SMALL))
    assert one.count("Scan parquet") < full.count("Scan parquet")
    assert "lineitem.parquet" not in one          # rates never touch lineitem


def test_top_k_is_take_ordered(spark, q):
    p = plan(q["top6_by_mean_filtered"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def _final_scans(df, table):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue().split("+- == Initial Plan ==")[0].count(f"/{table}.parquet")


def test_ind_scans_orders_once(spark, q):
    """Section-filtered query (per-family plan): one orders scan, no lineitem.
    Full-IND query (single-scan plan): one orders scan serves every order family."""
    one = q["section_listing"](spark, SF_SMALL)
    one.collect()
    assert _final_scans(one, "orders") == 1 and _final_scans(one, "lineitem") == 0
    full = q["section_profile"](spark, SF_SMALL)
    full.collect()
    assert _final_scans(full, "orders") == 1 and _final_scans(full, "lineitem") == 1


def test_both_ind_plans_yield_identical_rows(spark):
    from civicstat.plans.indicators import build_indicators, build_indicators_single_scan
    a = build_indicators(spark, SF_SMALL)
    b = build_indicators_single_scan(spark, SF_SMALL).select(*a.columns)
    assert a.count() == b.count()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_share_input_reads_checkpoint_once(spark):
    from pyspark.sql import functions as F
    from civicstat.operators import rank
    from civicstat.plans.indicators import indicators
    sel = indicators(spark, SF_SMALL).filter(F.col("characteristic") == "Open (rate)") \
        .withColumn("year", F.col("timeframe").cast("int"))
    shared = plan(rank.latest_global(sel, "year", share_input=True))
    lazy = plan(rank.latest_global(sel, "year"))
    assert "orders.parquet" not in shared and "ExistingRDD" in shared
    assert "orders.parquet" in lazy
