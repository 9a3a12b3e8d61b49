"""Ranking, top-k and "latest" queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.functions.numeric import exact_mean, lenient_double
from civicstat.operators import longform as L
from civicstat.operators import rank
from civicstat.plans.indicators import indicators, with_ind, YEAR_SQL, sql_str
from civicstat.plans.registry import query
from civicstat.sources.tables import load

_YEAR_SQL = YEAR_SQL


@query("latest_per_group", ids="W1 O7", sql=with_ind(f"""
WITH t AS (SELECT geography, indicator_value, {_YEAR_SQL} AS year FROM ind
           WHERE characteristic = 'High value (rate)'),
r AS (SELECT *, row_number() OVER (PARTITION BY geography ORDER BY year DESC, indicator_value DESC) AS rn
      FROM t WHERE year IS NOT NULL)
SELECT geography, year, indicator_value FROM r WHERE rn = 1
ORDER BY indicator_value
"""))
def latest_per_group(spark, d):
    """Newest year per geography; the stale nation keeps its own (older) year."""
    sel = L.with_year(L.select_indicators(indicators(spark, d, single_scan=True), characteristics=["High value (rate)"]))
    return (rank.latest_per_group(sel, "geography", "year", ["indicator_value"])
            .select("geography", "year", "indicator_value").orderBy("indicator_value"))


@query("latest_per_two_keys", ids="W1", sql=with_ind(f"""
WITH t AS (SELECT geography, characteristic, indicator_value, {_YEAR_SQL} AS year FROM ind
           WHERE dashboard_section = 'rates'),
r AS (SELECT *, row_number() OVER (PARTITION BY geography, characteristic
                                   ORDER BY year DESC, indicator_value DESC) AS rn
      FROM t WHERE year IS NOT NULL)
SELECT geography, characteristic, year, indicator_value FROM r WHERE rn = 1
ORDER BY geography, characteristic
"""))
def latest_per_two_keys(spark, d):
    sel = L.with_year(L.select_indicators(indicators(spark, d), section="rates"))
    return (rank.latest_per_group(sel, ["geography", "characteristic"], "year", ["indicator_value"])
            .select("geography", "characteristic", "year", "indicator_value")
            .orderBy("geography", "characteristic"))


@query("latest_global", ids="W2 O7", sql=with_ind(f"""
WITH t AS (SELECT geography, indicator_value, {_YEAR_SQL} AS year FROM ind
           WHERE characteristic = 'Open (rate)')
SELECT geography, year, indicator_value FROM t WHERE year = (SELECT max(year) FROM t)
ORDER BY indicator_value
"""))
def latest_global(spark, d):
    """Rows of the globally newest year; the stale nation drops out."""
    sel = L.with_year(L.select_indicators(indicators(spark, d, single_scan=True), characteristics=["Open (rate)"]))
    return (rank.latest_global(sel, "year", share_input=True).select("geography", "year", "indicator_value")
            .orderBy("indicator_value"))


@query("latest_event_per_user", ids="W1", sql="""
WITH r AS (SELECT user_id, ts, event_id, event_type, value,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
           FROM events)
SELECT user_id, ts, event_id, event_type, value FROM r WHERE rn = 1 ORDER BY user_id
""")
def latest_event_per_user(spark, d):
    """Latest-per-group straight on the event table (scales with events)."""
    ev = load(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return (rank.latest_per_group(ev, "user_id", "ts", ["event_type", "value"], tiebreak=["event_id"])
            .select("user_id", "ts", "event_id", "event_type", "value").orderBy("user_id"))


_REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))"


@query("top6_by_sum", ids="A12 O4 J8", sql=f"""
WITH rev AS (
  SELECT p_brand, l_returnflag, sum({_REVENUE}) AS revenue
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand, l_returnflag
),
top AS (SELECT p_brand FROM rev GROUP BY p_brand ORDER BY sum(revenue) DESC, p_brand LIMIT 6)
SELECT p_brand AS brand, l_returnflag, CAST(revenue AS DOUBLE) AS revenue
FROM rev WHERE p_brand IN (SELECT p_brand FROM top)
ORDER BY brand, l_returnflag
""")
def top6_by_sum(spark, d):
    """Six brands with the largest revenue, their revenue by return flag.

    lineitem is reduced to (part, flag) sums before meeting part, so the
    join moves one row per part and flag instead of every line.
    """
    li = load(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_extendedprice", "l_discount")
    rev_expr = (F.col("l_extendedprice").cast("decimal(18,2)")
                * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)")))
    per_part = li.groupBy("l_partkey", "l_returnflag").agg(F.sum(rev_expr).alias("revenue"))
    part = load(spark, d, "part").select("p_partkey", "p_brand")
    rev = (per_part.join(part, per_part.l_partkey == part.p_partkey)
           .groupBy("p_brand", "l_returnflag").agg(F.sum("revenue").alias("revenue")))
    kept = rank.keep_top_k(rev, "p_brand", "revenue", 6, "sum")
    return (kept.select(F.col("p_brand").alias("brand"), "l_returnflag",
                        F.col("revenue").cast("double").alias("revenue"))
            .orderBy("brand", "l_returnflag"))


@query("top6_by_mean_filtered", ids="A13 O4 J8", sql=with_ind("""
WITH top AS (
  SELECT geography FROM ind WHERE dashboard_section = 'demand' AND characteristic = 'Orders'
  GROUP BY geography ORDER BY avg(indicator_value) DESC, geography LIMIT 6
)
SELECT geography, characteristic, timeframe, indicator_value
FROM ind WHERE dashboard_section = 'rates' AND timeframe = '1999'
  AND geography IN (SELECT geography FROM top)
ORDER BY geography, characteristic
"""))
def top6_by_mean_filtered(spark, d):
    ind = indicators(spark, d)
    orders = L.select_indicators(ind, section="demand", characteristics=["Orders"])
    top = rank.top_k(orders, "geography", "indicator_value", 6, "avg").select("geography")
    rates = L.select_indicators(ind, section="rates", periods=["1999"])
    return (rates.join(F.broadcast(top), "geography", "left_semi")
            .select("geography", "characteristic", "timeframe", "indicator_value")
            .orderBy("geography", "characteristic"))


@query("avg_above_median", ids="A9 A15", sql=with_ind("""
WITH a AS (
  SELECT characteristic, CAST(sum(CAST(indicator_value AS DECIMAL(38,6))) AS DOUBLE) / count(indicator_value)
         AS avg_value, count(*) AS n_rows,
         count(indicator_value) AS n_values
  FROM ind WHERE dashboard_section = 'demand' AND timeframe = '1997'
  GROUP BY characteristic
)
SELECT characteristic, avg_value, n_rows, n_values,
       avg_value > (SELECT median(avg_value) FROM a) AS above_median
FROM a ORDER BY avg_value DESC
"""))
def avg_above_median(spark, d):
    sel = L.select_indicators(indicators(spark, d), section="demand", periods=["1997"])
    a = sel.groupBy("characteristic").agg(
        exact_mean("indicator_value").alias("avg_value"), F.count(F.lit(1)).alias("n_rows"),
        F.count("indicator_value").alias("n_values"))
    return rank.above_median(a, "avg_value", share_input=True).orderBy(F.col("avg_value").desc())


@query("typed_value_sort", ids="P16 O8 O1", sql=with_ind(r"""
WITH t AS (
  SELECT geography, coalesce(CAST(CAST(indicator_value AS BIGINT) AS VARCHAR), 'n/a') AS value_text
  FROM ind WHERE dashboard_section = 'demand' AND characteristic = 'Orders - 2-HIGH (number)'
    AND timeframe = '1999'
)
SELECT geography, value_text,
       CASE WHEN regexp_full_match(value_text, '\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*')
            THEN TRY_CAST(trim(value_text) AS DOUBLE) END AS numeric_value
FROM t ORDER BY numeric_value DESC NULLS LAST, geography
"""))
def typed_value_sort(spark, d):
    """Values delivered as text ('n/a' for suppressed), cast leniently, sorted as numbers."""
    sel = L.select_indicators(indicators(spark, d), section="demand",
                              characteristics=["Orders - 2-HIGH (number)"], periods=["1999"])
    t = sel.select("geography", F.coalesce(F.col("indicator_value").cast("bigint").cast("string"),
                                           F.lit("n/a")).alias("value_text"))
    return (t.withColumn("numeric_value", lenient_double("value_text"))
            .orderBy(F.col("numeric_value").desc_nulls_last(), "geography"))


# Segments of the driver data, as a Python list (P5: the IN list is assembled at run time).
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SHORT_SEGMENTS = {"AUTOMOBILE": "Cars", "BUILDING": "Build", "FURNITURE": "Home"}
COMMUNITIES = ["Europe", *(f"NATION_{i}" for i in range(25))]


def _industry_sql() -> str:
    short = "CASE industry " + " ".join(f"WHEN {sql_str(k)} THEN {sql_str(v)}" for k, v in SHORT_SEGMENTS.items()) + " ELSE industry END"
    return f"""
WITH census AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS geography_id, c_mktsegment AS characteristic,
         CAST(count(*) AS DOUBLE) AS indicator_value
  FROM customer GROUP BY 1, 2
),
geo AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS geography_id, n_name || ', ' || r_name AS geography
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
r AS (
  SELECT CASE WHEN g.geography LIKE '%, EUROPE' THEN 'Europe' ELSE split_part(g.geography, ',', 1) END
           AS community,
         c.characteristic AS industry, c.indicator_value AS workers
  FROM census c JOIN geo g ON c.geography_id = g.geography_id
  WHERE c.characteristic IN ({", ".join(sql_str(s) for s in SEGMENTS)})
),
top AS (SELECT industry FROM r GROUP BY industry ORDER BY sum(workers) DESC, industry LIMIT 3),
kept AS (SELECT {short} AS short, community, workers FROM r WHERE industry IN (SELECT industry FROM top))
SELECT short, {", ".join(f"coalesce(avg(workers) FILTER (community = {sql_str(c)}), 0) AS {c}" for c in COMMUNITIES)}
FROM kept GROUP BY short ORDER BY short
"""


@query("industry_top_pivot", ids="J5 P5 F2 F3 A12 O4 J8 F5 A17 A20", sql=_industry_sql())
def industry_top_pivot(spark, d):
    """The census industry analysis on a census-like long table: customers per
    (nation, segment); top 3 segments by total, mean per (label, community), 0-filled."""
    customer = load(spark, d, "customer")
    census = customer.groupBy(F.col("c_nationkey").cast("string").alias("geography_id"),
                              F.col("c_mktsegment").alias("characteristic")) \
        .agg(F.count(F.lit(1)).cast("double").alias("indicator_value"))
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("geography_id"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("geography"))
    from civicstat.plans.indicator_report import labour_force_top_industries
    return labour_force_top_industries(census, geo, k=3, industries=SEGMENTS, communities=COMMUNITIES,
                                       rules=(("%, EUROPE", "Europe"),), labels=SHORT_SEGMENTS)
