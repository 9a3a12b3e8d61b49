"""Reshaping queries (A16-A20, W3-W5, O5, O6, unpivot)."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.operators import longform as L
from civicstat.operators import reshape as R
from civicstat.plans.indicators import indicators, with_ind
from civicstat.plans.registry import query
from civicstat.plans.star_queries import PRIORITY_ORDER
from civicstat.sources.tables import load

PRIORITY_ALIASES = ("urgent", "high", "medium", "not_specified", "low")


@query("in_list_pivot_wide", ids="P4 A16 P19 A20", sql=with_ind("""
SELECT geography,
       coalesce(max(CASE WHEN characteristic = 'Orders - 1-URGENT (number)' THEN indicator_value END), 0) AS urgent,
       coalesce(max(CASE WHEN characteristic = 'Orders - 5-LOW (number)' THEN indicator_value END), 0) AS low,
       coalesce(max(CASE WHEN characteristic = 'Orders - 9-UNKNOWN (number)' THEN indicator_value END), 0) AS unknown
FROM ind
WHERE dashboard_section = 'demand' AND timeframe = '1998'
  AND characteristic IN ('Orders - 1-URGENT (number)', 'Orders - 5-LOW (number)', 'Orders - 9-UNKNOWN (number)')
GROUP BY geography
ORDER BY geography
"""))
def in_list_pivot_wide(spark, d):
    """An absent value ('9-UNKNOWN') still yields its column (P19), then 0-filled."""
    wanted = ["Orders - 1-URGENT (number)", "Orders - 5-LOW (number)", "Orders - 9-UNKNOWN (number)"]
    sel = L.select_indicators(indicators(spark, d), section="demand", characteristics=wanted, periods=["1998"])
    return R.pivot_unique(sel, "geography", "characteristic", "indicator_value", wanted,
                          aliases=["urgent", "low", "unknown"], fill=0).orderBy("geography")


@query("period_compare_pivot", ids="A16 A20 O5", sql=with_ind("""
SELECT geography,
       coalesce(max(CASE WHEN timeframe = '1995' THEN indicator_value END), 0) AS y1995,
       coalesce(max(CASE WHEN timeframe = '2000' THEN indicator_value END), 0) AS y2000
FROM ind
WHERE dashboard_section = 'demand' AND characteristic = 'Orders' AND timeframe IN ('1995', '2000')
GROUP BY geography
ORDER BY y2000
"""))
def period_compare_pivot(spark, d):
    sel = L.select_indicators(indicators(spark, d), section="demand", characteristics=["Orders"],
                              periods=["1995", "2000"])
    wide = R.pivot_unique(sel, "geography", "timeframe", "indicator_value", ["1995", "2000"],
                          aliases=["y1995", "y2000"], fill=0)
    return wide.orderBy("y2000")   # O5: sort by the last pivot column


NATIONS = [f"NATION_{i}" for i in range(25)]


@query("transposed_pivot", ids="A16", sql=with_ind(f"""
SELECT characteristic, {", ".join(f"max(indicator_value) FILTER (geography = '{n}') AS {n}" for n in NATIONS)}
FROM ind WHERE dashboard_section = 'rates' AND timeframe = '1997'
GROUP BY characteristic ORDER BY characteristic
"""))
def transposed_pivot(spark, d):
    """characteristic x geography, not filled (a comparison table)."""
    sel = L.select_indicators(indicators(spark, d), section="rates", periods=["1997"])
    return R.pivot_unique(sel, "characteristic", "geography", "indicator_value", NATIONS).orderBy("characteristic")


@query("pivot_duplicates_report", ids="A16", sql="""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
ORDER BY l_orderkey, l_linenumber
""")
def pivot_duplicates_report(spark, d):
    """Cells of a (order, line number) pivot that hold several rows."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return R.duplicate_cells(li, "l_orderkey", "l_linenumber").orderBy("l_orderkey", "l_linenumber")


def _cond_cols(expr_tpl, col, values, aliases):
    return ",\n       ".join(
        f"coalesce({expr_tpl.format(cond=f'{col} = ' + repr(v))}, 0) AS {a}" for v, a in zip(values, aliases))


@query("pivot_mean_fill", ids="A17 A20", sql=f"""
SELECT c_mktsegment AS segment,
       {_cond_cols("CAST(sum(CASE WHEN {cond} THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE)"
                   " / count(CASE WHEN {cond} THEN 1 END)", "o_orderpriority", PRIORITY_ORDER, PRIORITY_ALIASES)}
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment
ORDER BY segment
""")
def pivot_mean_fill(spark, d):
    """Mean order value: segment x priority, absent cells 0."""
    orders = load(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderpriority")
    customer = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = orders.join(customer, orders.o_custkey == customer.c_custkey)
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    wide = R.pivot_agg(j, F.col("c_mktsegment").alias("segment"), "o_orderpriority", mean,
                       PRIORITY_ORDER, aliases=PRIORITY_ALIASES, fill=0)
    return wide.orderBy("segment")


@query("pivot_sum_fill", ids="A19 A20", sql="""
SELECT l_returnflag,
       coalesce(CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS qty_f,
       coalesce(CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS qty_o,
       coalesce(CAST(sum(CASE WHEN l_linestatus = 'X' THEN CAST(l_quantity AS DECIMAL(18,2)) END) AS DOUBLE), 0) AS qty_x
FROM lineitem GROUP BY l_returnflag ORDER BY l_returnflag
""")
def pivot_sum_fill(spark, d):
    """Sum pivot straight on lineitem; status 'X' never occurs -> 0 column."""
    li = load(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    s = F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double")
    return R.pivot_agg(li, "l_returnflag", "l_linestatus", s, ["F", "O", "X"],
                       aliases=["qty_f", "qty_o", "qty_x"], fill=0).orderBy("l_returnflag")


_VALUE_CHARS = [f"Orders - {p} (Q4 value)" for p in PRIORITY_ORDER]


@query("pivot_latest", ids="A18 A20 O6", sql=with_ind("WITH t AS (SELECT geography, characteristic, indicator_value, "
       "CASE WHEN regexp_full_match(timeframe, '[0-9]{4}') THEN CAST(timeframe AS INTEGER) END AS year "
       "FROM ind WHERE dashboard_section = 'demand' AND characteristic LIKE 'Orders - %(Q4 value)' "
       "AND indicator_value IS NOT NULL)\nSELECT geography,\n       " + ",\n       ".join(
           f"coalesce(arg_max(indicator_value, year) FILTER (WHERE characteristic = '{c}'), 0) AS {a}"
           for c, a in zip(_VALUE_CHARS, PRIORITY_ALIASES)) + "\nFROM t GROUP BY geography ORDER BY geography"))
def pivot_latest(spark, d):
    """Latest non-null value per cell by parsed year (not by row order)."""
    sel = L.with_year(L.select_indicators(indicators(spark, d), section="demand", like="Orders - %(Q4 value)"))
    return R.pivot_latest(sel, "geography", "characteristic", "indicator_value", "year", _VALUE_CHARS,
                          aliases=PRIORITY_ALIASES, fill=0).orderBy("geography")


@query("unpivot_wide", ids="J7 A10", sql="""
WITH w AS (
  SELECT n_name AS community, CAST(count(*) AS DOUBLE) AS customers,
         CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance,
         CAST(count_if(c_acctbal < 0) AS DOUBLE) AS in_debt
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
)
SELECT community, 'customers' AS measure, customers AS value FROM w
UNION ALL SELECT community, 'balance', balance FROM w
UNION ALL SELECT community, 'in_debt', in_debt FROM w
ORDER BY community, measure
""")
def unpivot_wide(spark, d):
    customer = load(spark, d, "customer").select("c_nationkey", "c_acctbal")
    nation = load(spark, d, "nation").select("n_nationkey", "n_name")
    per = customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).cast("double").alias("customers"),
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance"),
        F.count_if(F.col("c_acctbal") < 0).cast("double").alias("in_debt"))
    wide = per.join(nation, per.c_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("community"), "customers", "balance", "in_debt")
    return R.unpivot(wide, ["community"], ["customers", "balance", "in_debt"], "measure", "value") \
        .orderBy("community", "measure")


@query("stack_offsets", ids="W3 A20", sql=with_ind("""
SELECT geography, characteristic, indicator_value,
       coalesce(sum(coalesce(indicator_value, 0)) OVER (PARTITION BY geography ORDER BY characteristic
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
FROM ind WHERE dashboard_section = 'segments' AND timeframe = '1998'
ORDER BY geography, characteristic
"""))
def stack_offsets(spark, d):
    sel = L.select_indicators(indicators(spark, d), section="segments", periods=["1998"])
    return (R.stack_offsets(sel.select("geography", "characteristic", "indicator_value"),
                            "geography", "characteristic", "indicator_value")
            .orderBy("geography", "characteristic"))


@query("series_ordered", ids="W4 F12", sql=with_ind("""
SELECT geography AS community, CAST(timeframe AS INTEGER) AS year, indicator_value AS orders
FROM ind WHERE dashboard_section = 'demand' AND characteristic = 'Orders'
ORDER BY community, year
"""))
def series_ordered(spark, d):
    sel = L.with_year(L.select_indicators(indicators(spark, d), section="demand", characteristics=["Orders"]))
    return R.ordered_series(sel.select(F.col("geography").alias("community"), "year",
                                       F.col("indicator_value").alias("orders")), ["community", "year"])


@query("series_mean", ids="W5 W4", sql=with_ind("""
SELECT geography AS community, CAST(timeframe AS INTEGER) AS year, avg(indicator_value) AS mean_orders
FROM ind WHERE dashboard_section = 'demand' AND characteristic LIKE 'Orders - %(number)'
GROUP BY geography, timeframe
ORDER BY community, year
"""))
def series_mean(spark, d):
    sel = L.with_year(L.select_indicators(indicators(spark, d), section="demand", like="Orders - %(number)"))
    m = R.mean_series(sel.withColumnRenamed("geography", "community"), ["community", "year"],
                      "indicator_value", "mean_orders")
    return R.ordered_series(m, ["community", "year"])


@query("stack_offsets_lineitem", ids="W3 A19", sql="""
WITH cells AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
  FROM lineitem GROUP BY 1, 2
)
SELECT year, l_returnflag, quantity,
       coalesce(sum(quantity) OVER (PARTITION BY year ORDER BY l_returnflag
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
FROM cells ORDER BY year, l_returnflag
""")
def stack_offsets_lineitem(spark, d):
    """Stack bases straight on lineitem: aggregate to cells first, then a
    window partitioned by year over at most one row per return flag."""
    li = load(spark, d, "lineitem").select(F.year("l_shipdate").alias("year"), "l_returnflag", "l_quantity")
    cells = li.groupBy("year", "l_returnflag").agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))
    return R.stack_offsets(cells, "year", "l_returnflag", "quantity").orderBy("year", "l_returnflag")
