"""Label and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.functions import labels as LB
from civicstat.functions.numeric import pct_half_up
from civicstat.operators import longform as L
from civicstat.plans.indicators import indicators, with_ind
from civicstat.plans.registry import query
from civicstat.sources.tables import load

# Fixed short labels for three order priorities; the others fall back to their code.
PRIORITY_SHORT = {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}


@query("label_case_split", ids="F2 F3", sql="""
SELECT n_nationkey,
       CASE WHEN r_name LIKE '%EAST%' THEN 'Mideast'
            ELSE split_part(n_name || ', ' || r_name, ',', 1) END AS community
FROM nation JOIN region ON n_regionkey = r_regionkey
ORDER BY n_nationkey
""")
def label_case_split(spark, d):
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    full = F.concat(F.col("n_name"), F.lit(", "), F.col("r_name"))
    label = LB.case_like("r_name", [("%EAST%", "Mideast")], LB.first_token(full, ","))
    return j.select("n_nationkey", label.alias("community")).orderBy("n_nationkey")


@query("label_strip", ids="F4", sql=with_ind("""
SELECT DISTINCT characteristic, replace(replace(characteristic, 'Orders - ', ''), ' (number)', '') AS short_label
FROM ind WHERE dashboard_section = 'demand'
ORDER BY characteristic
"""))
def label_strip(spark, d):
    sel = L.select_indicators(indicators(spark, d), section="demand").select("characteristic").distinct()
    return (sel.withColumn("short_label", LB.strip_literals("characteristic", ["Orders - ", " (number)"]))
            .orderBy("characteristic"))


@query("label_map_fallback", ids="F5 A12", sql="""
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low'
            ELSE o_orderpriority END AS label,
       count(*) AS orders
FROM orders GROUP BY 1 ORDER BY orders DESC, label
""")
def label_map_fallback(spark, d):
    orders = load(spark, d, "orders").select("o_orderpriority")
    return (orders.groupBy(LB.map_with_fallback("o_orderpriority", PRIORITY_SHORT).alias("label"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy(F.col("orders").desc(), "label"))


@query("label_number_text", ids="F8 F6 F7", sql="""
WITH a AS (
  SELECT n_name AS community, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_value,
         count(*) AS n, count_if(o_orderstatus = 'O') AS n_open
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name
)
SELECT community,
       format('{:,.0f}', CAST(n AS DOUBLE)) AS orders_text,
       '$' || format('{:,.0f}', CAST(total_value AS DOUBLE)) AS value_text,
       format('{:.1f}', CAST((2000 * n_open + n) // (2 * n) AS DOUBLE) / 10) || '%' AS open_text
FROM a ORDER BY community
""")
def label_number_text(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, d, "nation").select("n_nationkey", "n_name")
    a = (orders.join(customer, orders.o_custkey == customer.c_custkey)
         .join(nation, customer.c_nationkey == nation.n_nationkey)
         .groupBy(F.col("n_name").alias("community"))
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_value"),
              F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open")))
    open_pct = pct_half_up(F.col("n_open"), F.col("n"), 1)
    return a.select("community",
                    LB.number_text(F.col("n").cast("double"), 0).alias("orders_text"),
                    LB.currency_text(F.col("total_value").cast("double"), 0).alias("value_text"),
                    LB.percent_text(open_pct, 1).alias("open_text")).orderBy("community")


@query("name_contains", ids="F9", sql="""
SELECT n_nationkey, n_name, strpos(lower(n_name), 'nation_1') > 0 AS matched
FROM nation ORDER BY n_nationkey
""")
def name_contains(spark, d):
    """Case-insensitive substring test on a name."""
    nation = load(spark, d, "nation")
    return nation.select("n_nationkey", "n_name", LB.contains_ci("n_name", "NATION_1").alias("matched")) \
        .orderBy("n_nationkey")
