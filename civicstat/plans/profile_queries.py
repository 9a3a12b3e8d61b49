"""Profiles of IND (A3-A8, A21) and community coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.operators import profile as P
from civicstat.plans.indicators import (CUSTOMER_SECTIONS, customers, gap_indicators, geography, indicators,
                                         with_gap_ind, with_ind, YEAR_SQL)
from civicstat.plans.registry import query
from civicstat.sources.tables import load

SECTIONS = ("demand", "rates", "segments", "shipments")
_YEAR_SQL = YEAR_SQL
_SECTIONS_SQL = ", ".join(f"('{s}')" for s in SECTIONS)
# Every section with every community that it could have.
GRID_SQL = f"""SELECT s.dashboard_section, n_name AS geography FROM nation, (VALUES {_SECTIONS_SQL}) s(dashboard_section)
  UNION ALL
  SELECT s.dashboard_section, c_name FROM customer, (VALUES {", ".join(f"('{s}')" for s in CUSTOMER_SECTIONS)}) s(dashboard_section)"""


@query("section_profile", ids="A3", sql=with_ind("""
SELECT dashboard_section, count(*) AS row_count, count(DISTINCT geography) AS communities,
       count(DISTINCT characteristic) AS characteristics, count(DISTINCT timeframe) AS timeframes
FROM ind GROUP BY dashboard_section ORDER BY dashboard_section
"""))
def section_profile(spark, d):
    return P.section_profile(indicators(spark, d, single_scan=True)).orderBy("dashboard_section")


@query("characteristic_profile", ids="A4", sql=with_ind("""
SELECT dashboard_section, characteristic, count(*) AS row_count, count(DISTINCT geography) AS communities,
       count(DISTINCT timeframe) AS timeframes
FROM ind GROUP BY dashboard_section, characteristic ORDER BY dashboard_section, characteristic
"""))
def characteristic_profile(spark, d):
    return P.characteristic_profile(indicators(spark, d, single_scan=True)).orderBy("dashboard_section", "characteristic")


_COMPLETE_SQL = f"""count(*) AS total_rows, count(DISTINCT geography) AS communities,
       count(DISTINCT characteristic) AS characteristics, count(DISTINCT timeframe) AS timeframes,
       min(timeframe) AS earliest_period, max(timeframe) AS latest_period,
       min({_YEAR_SQL}) AS earliest_year, max({_YEAR_SQL}) AS latest_year,
       CAST(count_if(indicator_value IS NULL) AS BIGINT) AS null_values,
       CAST((2000 * count(indicator_value) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS pct_complete"""


@query("completeness_profile", ids="A5 A6 A7 A8", sql=with_ind(f"""
SELECT dashboard_section, {_COMPLETE_SQL}
FROM ind GROUP BY dashboard_section ORDER BY dashboard_section
"""))
def completeness_profile(spark, d):
    return P.completeness_profile(indicators(spark, d, single_scan=True)).orderBy("dashboard_section")


@query("completeness_rollup", ids="A21 A5", sql=with_ind(f"""
SELECT CASE WHEN grouping(dashboard_section) = 1 THEN 'TOTAL' ELSE dashboard_section END AS dashboard_section,
       {_COMPLETE_SQL}, grouping(dashboard_section) = 1 AS is_total
FROM ind GROUP BY ROLLUP (dashboard_section) ORDER BY is_total, dashboard_section
"""))
def completeness_rollup(spark, d):
    return P.completeness_rollup(indicators(spark, d, single_scan=True)).orderBy("is_total", "dashboard_section")


@query("coverage_matrix_zero", ids="G3 A2", sql=with_gap_ind(f"""
WITH c AS (SELECT dashboard_section, geography, count(*) AS n FROM ind GROUP BY 1, 2),
grid AS ({GRID_SQL})
SELECT g.dashboard_section, g.geography, coalesce(c.n, 0) AS rows
FROM grid g LEFT JOIN c ON g.dashboard_section = c.dashboard_section AND g.geography = c.geography
ORDER BY g.dashboard_section, g.geography
"""))
def coverage_matrix_zero(spark, d):
    """Rows per (section, community) incl. zero cells: most customers have no event."""
    return coverage_matrix(gap_indicators(spark, d), spark, d).select(
        "dashboard_section", "geography", "rows").orderBy("dashboard_section", "geography")


def coverage_matrix(ind, spark, d):
    """The cells of nations and of customers."""
    return P.coverage_matrix(ind, geography(spark, d), SECTIONS).unionByName(
        P.coverage_matrix(ind, customers(spark, d), CUSTOMER_SECTIONS))


@query("gap_coverage", ids="G3", sql=with_gap_ind(f"""
WITH c AS (SELECT dashboard_section, geography, count(*) AS n FROM ind GROUP BY 1, 2),
grid AS ({GRID_SQL}),
m AS (SELECT g.dashboard_section, g.geography, coalesce(c.n, 0) AS rows FROM grid g LEFT JOIN c
      ON g.dashboard_section = c.dashboard_section AND g.geography = c.geography)
SELECT dashboard_section, CAST(count_if(rows > 0) AS BIGINT) AS covered, count(*) AS total,
       CAST(count_if(rows = 0) AS BIGINT) AS uncovered
FROM m GROUP BY dashboard_section ORDER BY dashboard_section
"""))
def gap_coverage(spark, d):
    """Covered n of N; ``gap_uncovered`` has the names, one a row, since customers are too many for one cell."""
    m = coverage_matrix(gap_indicators(spark, d), spark, d)
    return P.coverage_summary(m, names=False).orderBy("dashboard_section")


UNCOVERED_SQL = f"""
SELECT dashboard_section, geography, CAST(covered AS BIGINT) AS covered, total FROM (
  SELECT *, count_if(rows > 0) OVER (PARTITION BY dashboard_section) AS covered, count(*) OVER (PARTITION BY dashboard_section) AS total
  FROM (SELECT g.dashboard_section, g.geography, coalesce(c.n, 0) AS rows
        FROM ({GRID_SQL}) g LEFT JOIN (SELECT dashboard_section, geography, count(*) AS n FROM ind GROUP BY 1, 2) c
        ON g.dashboard_section = c.dashboard_section AND g.geography = c.geography))
WHERE rows = 0
"""


@query("gap_uncovered", ids="G3", sql=with_gap_ind(UNCOVERED_SQL + "ORDER BY 1, 2"))
def gap_uncovered(spark, d):
    return P.uncovered(coverage_matrix(gap_indicators(spark, d), spark, d)).orderBy("dashboard_section", "geography")


@query("event_profile", ids="A3 A5", sql="""
SELECT event_type, count(*) AS row_count, count(DISTINCT user_id) AS users,
       CAST(count_if(value IS NULL) AS BIGINT) AS null_values,
       strftime(CAST(min(ts) AS DATE), '%Y-%m-%d') AS first_day,
       strftime(CAST(max(ts) AS DATE), '%Y-%m-%d') AS last_day
FROM events GROUP BY event_type ORDER BY event_type
""")
def event_profile(spark, d):
    """The section profile shape straight on the event table (scales with events)."""
    ev = load(spark, d, "events")
    return (ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("user_id").alias("users"),
        F.count_if(F.col("value").isNull()).alias("null_values"),
        # ISO text: dates reach pandas as different types from the two engines
        F.date_format(F.to_date(F.min("ts")), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.to_date(F.max("ts")), "yyyy-MM-dd").alias("last_day"))
        .orderBy("event_type"))
