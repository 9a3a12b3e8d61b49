"""Long-table selection queries on IND."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.operators import longform as L
from civicstat.operators import rank
from civicstat.plans.indicators import indicators, with_ind
from civicstat.plans.registry import query
from civicstat.sources.catalog import section_view

_COLS = ["geography", "characteristic", "timeframe", "indicator_value"]


@query("section_listing", ids="S3 S11", sql=with_ind("""
SELECT geography, characteristic, timeframe, indicator_value, data_source
FROM ind WHERE dashboard_section = 'rates'
ORDER BY geography, characteristic, timeframe
"""))
def section_listing(spark, d):
    view = section_view(indicators(spark, d), "rates", "v_rates")
    return view.select(*_COLS, "data_source").orderBy("geography", "characteristic", "timeframe")


def _like_query(name, ids, where_sql, **sel):
    sql = with_ind(f"""
SELECT geography, characteristic, timeframe, indicator_value FROM ind
WHERE {where_sql}
ORDER BY geography, characteristic, timeframe
""")

    @query(name, ids=ids, sql=sql)
    def _q(spark, d):
        # without a section filter every family is read: one orders scan serves them all
        ind = indicators(spark, d, single_scan="section" not in sel)
        return (L.select_indicators(ind, **sel).select(*_COLS)
                .orderBy("geography", "characteristic", "timeframe"))
    return _q


_like_query("like_prefix", "P10 P3", "dashboard_section = 'demand' AND characteristic LIKE 'Orders - %' "
            "AND timeframe = '1998'", section="demand", like="Orders - %", periods=["1998"])
_like_query("like_suffix", "P10", "characteristic LIKE '%(rate)'", like="%(rate)")
_like_query("like_infix", "P10", "characteristic LIKE '%URGENT%'", like="%URGENT%")
_like_query("like_inner", "P11", "characteristic LIKE 'Orders%LOW%'", like="Orders%LOW%")
_like_query("not_like_and_like", "P12 P11", "characteristic LIKE 'Orders - %' AND characteristic NOT LIKE '%value%'",
            like="Orders - %", not_like="%value%")
_like_query("like_or_like", "P13", "(characteristic LIKE 'Segment:%' OR characteristic LIKE '%BUILDING%') "
            "AND timeframe = '1996'", any_like=["Segment:%", "%BUILDING%"], periods=["1996"])
_like_query("in_list_exact", "P4 P3", "dashboard_section = 'demand' AND characteristic IN "
            "('Orders', 'Orders - 2-HIGH (number)') AND timeframe IN ('1995', '2001')",
            section="demand", characteristics=["Orders", "Orders - 2-HIGH (number)"], periods=["1995", "2001"])


def _fallback(spark, d, narrow: str, broad: str):
    ind = L.with_year(indicators(spark, d).filter(F.col("dashboard_section") == "rates"))
    picked = L.fallback_select(ind, [F.col("characteristic").like(narrow), F.col("characteristic").like(broad)],
                               share_input=True)
    latest = rank.latest_per_group(picked, "geography", "year", ["indicator_value"], tiebreak=["characteristic"])
    return latest.select("geography", "year", "characteristic", "indicator_value").orderBy("indicator_value")


def _fallback_sql(narrow: str, broad: str) -> str:
    return with_ind(f"""
WITH t AS (
  SELECT geography, characteristic, indicator_value,
         CASE WHEN regexp_full_match(timeframe, '[0-9]{{4}}') THEN CAST(timeframe AS INTEGER) END AS year,
         CASE WHEN characteristic LIKE '{narrow}' THEN 0 WHEN characteristic LIKE '{broad}' THEN 1 END AS tier
  FROM ind WHERE dashboard_section = 'rates'
),
sel AS (SELECT * FROM t WHERE tier = (SELECT min(tier) FROM t) AND year IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY geography ORDER BY year DESC, characteristic DESC) AS rn FROM sel
)
SELECT geography, year, characteristic, indicator_value FROM ranked WHERE rn = 1
ORDER BY indicator_value
""")


@query("fallback_hit", ids="P17 W1 O7", sql=_fallback_sql("Open%(rate)", "%(rate)"))
def fallback_hit(spark, d):
    """Narrow pattern present: only its rows are used."""
    return _fallback(spark, d, "Open%(rate)", "%(rate)")


@query("fallback_broad", ids="P17 W1 O7", sql=_fallback_sql("Vacancy Rate%Total%", "%(rate)"))
def fallback_broad(spark, d):
    """Narrow pattern absent: every row of the broad pattern is used."""
    return _fallback(spark, d, "Vacancy Rate%Total%", "%(rate)")
