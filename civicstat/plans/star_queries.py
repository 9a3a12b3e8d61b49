"""Star-schema query shapes on the driver tables (dashboard queries 1-20).

Analogue: geography -> nation (type -> region), facts -> customer / orders /
lineitem / supplier / part, year -> order year.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.functions.labels import category_ordinal
from civicstat.operators import star
from civicstat.plans.indicators import indicators, with_ind
from civicstat.plans.registry import query
from civicstat.sources.tables import load

# Fixed order of the driver's order priorities.
PRIORITY_ORDER = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _nation(spark, d):
    return load(spark, d, "nation").select("n_nationkey", "n_name", "n_regionkey")


@query("table_coverage_union", ids="A2 U1 O3 J1", sql="""
SELECT 'customer' AS table_name, n_name AS community, count(*) AS rows
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
UNION ALL
SELECT 'supplier', n_name, count(*)
FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
UNION ALL
SELECT 'orders', n_name, count(*)
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
UNION ALL
SELECT 'lineitem', n_name, count(*)
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
ORDER BY table_name, community
""")
def table_coverage_union(spark, d):
    """Rows per community in four facts, stacked (dashboard query 20).

    The two large facts are first reduced to one count per join key (partial
    aggregation before any shuffle of the fact), so the join to the
    customer / supplier side moves key counts, not fact rows.
    """
    nation = _nation(spark, d)
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    supplier = load(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    orders_per_cust = (load(spark, d, "orders").groupBy("o_custkey")
                       .agg(F.count(F.lit(1)).alias("n")))
    lines_per_supp = (load(spark, d, "lineitem").groupBy("l_suppkey")
                      .agg(F.count(F.lit(1)).alias("n")))

    def by_nation(df, nk, weight=None):
        j = df.join(nation, df[nk] == nation.n_nationkey)
        w = F.count(F.lit(1)) if weight is None else F.sum(weight)
        return j.groupBy("n_name").agg(w.cast("bigint").alias("rows"))

    parts = {
        "customer": by_nation(customer, "c_nationkey"),
        "supplier": by_nation(supplier, "s_nationkey"),
        "orders": by_nation(orders_per_cust.join(customer, orders_per_cust.o_custkey == customer.c_custkey),
                            "c_nationkey", "n"),
        "lineitem": by_nation(lines_per_supp.join(supplier, lines_per_supp.l_suppkey == supplier.s_suppkey),
                              "s_nationkey", "n"),
    }
    frames = [df.select(F.lit(name).alias("table_name"), F.col("n_name").alias("community"), "rows")
              for name, df in parts.items()]
    return star.union_all(frames).orderBy("table_name", "community")


@query("star_enrich_rename", ids="J1 P1 O1", sql="""
SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS community,
       c_acctbal AS balance, c_mktsegment AS segment
FROM customer JOIN nation ON c_nationkey = n_nationkey
ORDER BY balance DESC, customer_id
""")
def star_enrich_rename(spark, d):
    customer = load(spark, d, "customer")
    nation = _nation(spark, d)
    out = star.enrich(customer, nation, customer.c_nationkey == nation.n_nationkey, {
        "customer_id": "c_custkey", "customer_name": "c_name", "community": "n_name",
        "balance": "c_acctbal", "segment": "c_mktsegment"})
    return out.orderBy(F.col("balance").desc(), "customer_id")


@query("star_multi_predicate", ids="P3 P7 P8 J1", sql="""
SELECT o_orderkey, n_name AS community, CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'F' AND n_name = 'NATION_7' AND o_orderpriority != '1-URGENT'
  AND o_totalprice > 100000
ORDER BY year, o_orderkey
""")
def star_multi_predicate(spark, d):
    orders = load(spark, d, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") != "1-URGENT")
        & (F.col("o_totalprice") > 100000))
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = _nation(spark, d).filter(F.col("n_name") == "NATION_7")
    cust = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return (orders.join(cust, orders.o_custkey == cust.c_custkey)
            .select("o_orderkey", F.col("n_name").alias("community"),
                    F.year("o_orderdate").alias("year"), "o_totalprice")
            .orderBy("year", "o_orderkey"))


@query("star_not_in_positive", ids="P6 P8", sql="""
SELECT p_partkey, p_type, p_size, p_retailprice
FROM part
WHERE p_type NOT IN ('PROMO', 'SMALL') AND p_retailprice > 950
ORDER BY p_type, p_partkey
""")
def star_not_in_positive(spark, d):
    part = load(spark, d, "part")
    return (part.filter(~F.col("p_type").isin("PROMO", "SMALL") & (F.col("p_retailprice") > 950))
            .select("p_partkey", "p_type", "p_size", "p_retailprice")
            .orderBy("p_type", "p_partkey"))


@query("ordered_categories", ids="O2 F1 A2 J1", sql="""
SELECT n_name AS community, o_orderpriority AS priority, count(*) AS orders,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
            WHEN '4-NOT SPECIFIED' THEN 4 WHEN '5-LOW' THEN 5 END AS INTEGER) AS priority_rank
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority
ORDER BY community, priority_rank
""")
def ordered_categories(spark, d):
    orders = load(spark, d, "orders").select("o_custkey", "o_orderpriority")
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = _nation(spark, d)
    j = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey)
    g = j.groupBy(F.col("n_name").alias("community"), F.col("o_orderpriority").alias("priority")) \
         .agg(F.count(F.lit(1)).alias("orders"))
    return (g.withColumn("priority_rank", category_ordinal("priority", PRIORITY_ORDER))
            .orderBy("community", "priority_rank"))


@query("three_way_sum", ids="J2 A10", sql="""
SELECT n_nationkey AS nation_key, n_name AS community, r_name AS region,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS total_balance,
       count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY n_nationkey, n_name, r_name
ORDER BY nation_key
""")
def three_way_sum(spark, d):
    customer = load(spark, d, "customer").select("c_nationkey", "c_acctbal")
    nation = _nation(spark, d)
    region = load(spark, d, "region")
    # aggregate the fact by its key first, then attach both dimensions
    per_nation = customer.groupBy("c_nationkey").agg(
        F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("bal"), F.count(F.lit(1)).alias("customers"))
    j = (per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey)
         .join(region, nation.n_regionkey == region.r_regionkey))
    return j.select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("community"),
                    F.col("r_name").alias("region"), F.col("bal").cast("double").alias("total_balance"),
                    "customers").orderBy("nation_key")


@query("star_null_filtered_series", ids="P9 O1", sql=with_ind("""
SELECT geography AS community, CAST(timeframe AS INTEGER) AS year, indicator_value AS urgent_value
FROM ind
WHERE dashboard_section = 'demand' AND characteristic = 'Orders - 1-URGENT (Q4 value)'
  AND indicator_value IS NOT NULL
ORDER BY community, year
"""))
def star_null_filtered_series(spark, d):
    ind = indicators(spark, d)
    return (ind.filter((F.col("dashboard_section") == "demand")
                       & (F.col("characteristic") == "Orders - 1-URGENT (Q4 value)")
                       & F.col("indicator_value").isNotNull())
            .select(F.col("geography").alias("community"), F.col("timeframe").cast("int").alias("year"),
                    F.col("indicator_value").alias("urgent_value"))
            .orderBy("community", "year"))


@query("dynamic_in_list", ids="P5 J5 A2", sql="""
SELECT n_name AS community, o_orderpriority AS priority, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
GROUP BY n_name, o_orderpriority
ORDER BY community, orders DESC
""")
def dynamic_in_list(spark, d, priorities=("1-URGENT", "2-HIGH")):
    """P5: the IN list comes from a Python list; no SQL text is spliced."""
    orders = load(spark, d, "orders").filter(F.col("o_orderpriority").isin(list(priorities)))
    customer = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    nation = _nation(spark, d)
    j = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey)
    return (j.groupBy(F.col("n_name").alias("community"), F.col("o_orderpriority").alias("priority"))
            .agg(F.count(F.lit(1)).alias("orders")).orderBy("community", F.col("orders").desc()))


@query("union_distinct_refs", ids="U2 U3 J4", sql="""
WITH refs AS (
  SELECT s_nationkey AS nk FROM supplier
  UNION
  SELECT c_nationkey FROM customer
)
SELECT n_nationkey, n_name AS community,
       CASE WHEN refs.nk IS NOT NULL THEN 'USED' ELSE 'UNUSED' END AS status
FROM nation LEFT JOIN refs ON n_nationkey = refs.nk
ORDER BY n_nationkey
""")
def union_distinct_refs(spark, d):
    s = load(spark, d, "supplier").select(F.col("s_nationkey").alias("nk"))
    c = load(spark, d, "customer").select(F.col("c_nationkey").alias("nk"))
    refs = star.union_distinct([s, c])
    nation = _nation(spark, d).select("n_nationkey", F.col("n_name").alias("community"))
    flagged = star.presence_flag(nation, refs.withColumnRenamed("nk", "n_nationkey"), "n_nationkey")
    return flagged.select("n_nationkey", "community", "status").orderBy("n_nationkey")


@query("distinct_dim", ids="A11", sql=with_ind("""
SELECT DISTINCT geography, geography_id, geography_type FROM ind ORDER BY geography
"""))
def distinct_dim(spark, d):
    ind = indicators(spark, d, single_scan=True)
    return star.distinct_rows(ind, ["geography", "geography_id", "geography_type"]).orderBy("geography")


@query("key_star_projection", ids="P2 J1", sql="""
SELECT n_name AS community, customer.*
FROM customer JOIN nation ON c_nationkey = n_nationkey
ORDER BY c_custkey
""")
def key_star_projection(spark, d):
    """Dimension key plus every fact column (``SELECT g.key, d.*``)."""
    customer = load(spark, d, "customer")
    nation = _nation(spark, d)
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return j.select(F.col("n_name").alias("community"), customer["*"]).orderBy("c_custkey")


@query("group_size", ids="A14", sql="""
SELECT user_id, count(*) AS events FROM events GROUP BY user_id ORDER BY user_id
""")
def group_size(spark, d):
    return star.group_count(load(spark, d, "events"), "user_id", "events").orderBy("user_id")
