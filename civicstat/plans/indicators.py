"""The long indicator table ``IND`` derived from the driver tables.

Shape: (dashboard_section, geography, geography_id, geography_type,
characteristic, timeframe, indicator_value, data_source), one row per
section x geography x characteristic x period.

    geography = n_name, geography_id = text of n_nationkey,
    geography_type = r_name, timeframe = text of the year.

Sections
    demand     'Orders'; 'Orders - <priority> (number)', '(value)' and
               '(Q4 value)', the value of the year's fourth quarter: NULL
               while a year has none
    rates      'High value (rate)' (o_totalprice > 250,000) and 'Open (rate)'
               (status O), percent with one decimal (half up)
    segments   'Segment: <c_mktsegment>' order counts per year plus one
               'All years' row per nation and segment (a non-year period)
    shipments  'Shipments - <l_returnflag>' summed l_quantity by ship year
               and supplier nation

Every row of the source tables counts. ``gap_indicators`` adds the series of
single customers, which have gaps of their own, as the input of the gap and
coverage queries.

Plan: orders meet customer (broadcast while customer is under the size
threshold, else a sort-merge join on the customer key, whose hot keys AQE
splits) and are reduced, with map-side partial aggregation, to a
cell table (nation, year, priority, segment) that has at most a few
thousand rows at any scale; a hot nation or year never lands whole in one
task.  Two plans yield identical rows (see ``indicators``): per-family
branches for selective queries (section filters remove whole branches,
period filters reach the orders scan before the join) and a single-scan
plan for queries reading several sections (grouping sets over the small
cell table, one generator).  Money is summed as DECIMAL(18,2) so sums do
not depend on row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.functions.numeric import pct_half_up
from civicstat.sources.tables import load

HIGH_VALUE = 250000
# Sections of the customers' series, by the table that they come from.
CUSTOMER_SECTIONS = ("orders", "activity")


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nk"),
        F.col("n_name").alias("geography"),
        F.col("n_nationkey").cast("string").alias("geography_id"),
        F.col("r_name").alias("geography_type"))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's nation and segment, one row an order."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    orders = load(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("yr"), F.col("o_orderpriority").alias("prio"), price.alias("amt"),
        F.when(F.quarter("o_orderdate") == 4, price).alias("q4"),
        (F.col("o_totalprice") > HIGH_VALUE).alias("h"), (F.col("o_orderstatus") == "O").alias("o"))
    customer = load(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("nk"), F.col("c_mktsegment").alias("seg"))
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def _rate(part: str, whole: str):
    # round-half-up of 100 * part / whole to one decimal, in exact integers
    return pct_half_up(F.col(part), F.col(whole), 1)


def _rows(section: str, source: str, timeframe, cells: list[tuple]):
    """Columns of ``section`` rows: one generated row per (characteristic, value) pair."""
    arr = F.array(*[F.struct(c.alias("characteristic"), v.cast("double").alias("indicator_value"))
                    for c, v in cells])
    return [F.lit(section).alias("dashboard_section"), F.col("nk"), timeframe.alias("timeframe"),
            F.inline(arr), F.lit(source).alias("data_source")]


def indicators(spark: SparkSession, sf_dir: str, single_scan: bool = False) -> DataFrame:
    """IND over the tables in ``sf_dir``.

    Two plans give identical rows; the query picks the one that fits its
    access pattern:

    * ``single_scan=False`` (``build_indicators``): one branch per section
      family.  A caller's section filter removes whole branches and a
      period filter reaches the orders scan before the join, so selective
      queries read only what they need.
    * ``single_scan=True`` (``build_indicators_single_scan``): all order
      families come from ONE cell aggregate, for queries that read all (or
      several) sections; orders is scanned and joined once.
    """
    return (build_indicators_single_scan if single_scan else build_indicators)(spark, sf_dir)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers as a geography dimension."""
    return load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("geography"), F.col("c_custkey").cast("string").alias("geography_id"),
        F.col("c_mktsegment").alias("geography_type"), F.col("c_custkey").alias("ck"))


def customer_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long table of single customers: orders by priority and year, events by type and year.

    Most customers have years without an order and no event at all. One row
    for each cell with a row of the source, so it grows with the tables.
    """
    orders = (load(spark, sf_dir, "orders")
              .groupBy(F.col("o_custkey").alias("ck"), F.concat(F.lit("Orders - "), "o_orderpriority").alias("characteristic"),
                       F.year("o_orderdate").cast("string").alias("timeframe"))
              .agg(F.count(F.lit(1)).cast("double").alias("indicator_value"))
              .select(F.lit("orders").alias("dashboard_section"), F.lit("orders").alias("data_source"), "*"))
    events = (load(spark, sf_dir, "events")
              .groupBy(F.col("user_id").alias("ck"), F.concat(F.lit("Events - "), "event_type").alias("characteristic"),
                       F.year("ts").cast("string").alias("timeframe"))
              .agg(F.count(F.lit(1)).cast("double").alias("indicator_value"))
              .select(F.lit("activity").alias("dashboard_section"), F.lit("events").alias("data_source"), "*"))
    return orders.unionByName(events).join(customers(spark, sf_dir), "ck").select(
        "dashboard_section", "geography", "geography_id", "geography_type",
        "characteristic", "timeframe", "indicator_value", "data_source")


def gap_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IND and the customers' series: what the gap and coverage queries read."""
    return indicators(spark, sf_dir, single_scan=True).unionByName(customer_series(spark, sf_dir))


def order_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer reduced to (nation, year, priority, segment) cells.

    Scan, join and map-side partial aggregation produce at most nations x
    years x priorities x segments rows at any scale; every section family
    re-aggregates them.  In the per-family plan Catalyst prunes each
    family's copy of this aggregate to the measures it needs and pushes a
    caller's period filter below it into the orders scan (before the join);
    the single-scan plan computes it once for all families.
    """
    return order_facts(spark, sf_dir).groupBy("nk", "yr", "prio", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amt").alias("amt"), F.sum("q4").alias("q4"),
        F.count_if("h").alias("h"), F.count_if("o").alias("o"))


def build_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build IND from the order cells and the shipment aggregate.

    Rows of a family are generated from its aggregate with ``inline``; a
    section filter from the caller removes whole union branches before
    anything is scanned, and period filters reach the orders scan.
    """
    cells = order_cells(spark, sf_dir)
    year_txt = F.col("yr").cast("string")

    per_year = cells.groupBy("nk", "yr").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.sum("o").alias("o"))
    demand_total = per_year.select(*_rows("demand", "orders", year_txt, [(F.lit("Orders"), F.col("n"))]))
    rates = per_year.select(*_rows("rates", "orders", year_txt, [
        (F.lit("High value (rate)"), _rate("h", "n")), (F.lit("Open (rate)"), _rate("o", "n"))]))

    per_prio = cells.groupBy("nk", "yr", "prio").agg(*[F.sum(c).alias(c) for c in ("n", "amt", "q4")])
    demand_prio = per_prio.select(*_rows("demand", "orders", year_txt, [
        (F.concat(F.lit("Orders - "), "prio", F.lit(" (number)")), F.col("n")),
        (F.concat(F.lit("Orders - "), "prio", F.lit(" (value)")), F.col("amt")),
        (F.concat(F.lit("Orders - "), "prio", F.lit(" (Q4 value)")), F.col("q4"))]))

    # per year and over all years in one aggregation (grouping sets)
    per_seg = cells.groupingSets([["nk", "seg", "yr"], ["nk", "seg"]], "nk", "seg", "yr").agg(
        F.sum("n").alias("n"), F.grouping("yr").alias("all_years"))
    seg_tf = F.when(F.col("all_years") == 1, F.lit("All years")).otherwise(year_txt)
    segments = per_seg.select(*_rows("segments", "orders", seg_tf, [
        (F.concat(F.lit("Segment: "), "seg"), F.col("n"))]))

    shipments = _shipments(spark, sf_dir)

    parts = [demand_total, demand_prio, rates, segments, shipments]
    body = parts[0]
    for p in parts[1:]:
        body = body.unionByName(p)
    geo = geography(spark, sf_dir)
    return body.join(geo, "nk").select(
        "dashboard_section", "geography", "geography_id", "geography_type",
        "characteristic", "timeframe", "indicator_value", "data_source")


def _shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem summed by supplier, year and flag before it meets supplier."""
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nk"))
    lineitem = (load(spark, sf_dir, "lineitem")
                .groupBy("l_suppkey", F.year("l_shipdate").alias("yr"), "l_returnflag")
                .agg(F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q")))
    ship = (lineitem.join(supplier, lineitem.l_suppkey == supplier.s_suppkey)
            .groupBy("nk", "yr", "l_returnflag").agg(F.sum("q").alias("q")))
    return ship.select(*_rows("shipments", "lineitem", F.col("yr").cast("string"), [
        (F.concat(F.lit("Shipments - "), "l_returnflag"), F.col("q"))]))


def _finish(spark: SparkSession, sf_dir: str, body: DataFrame) -> DataFrame:
    geo = geography(spark, sf_dir)
    return body.join(geo, "nk").select(
        "dashboard_section", "geography", "geography_id", "geography_type",
        "characteristic", "timeframe", "indicator_value", "data_source")


def build_indicators_single_scan(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """IND with one orders scan: the cells are re-aggregated by grouping sets
    (the ``Expand`` multiplies only the few-thousand-row cell table) and
    every order family's rows come from one generator.  A caller that has
    ``order_cells`` already passes them."""
    cells = order_cells(spark, sf_dir) if cells is None else cells
    fam = cells.groupingSets([["nk", "yr"], ["nk", "yr", "prio"], ["nk", "seg", "yr"], ["nk", "seg"]],
                             "nk", "yr", "prio", "seg").agg(
        *[F.sum(c).alias(c) for c in ("n", "amt", "q4", "h", "o")],
        F.grouping("yr").alias("g_yr"), F.grouping("prio").alias("g_prio"), F.grouping("seg").alias("g_seg"))
    year_txt = F.col("yr").cast("string")

    def row(section, characteristic, timeframe, value):
        return F.struct(F.lit(section).alias("dashboard_section"), characteristic.alias("characteristic"),
                        timeframe.alias("timeframe"), value.cast("double").alias("indicator_value"))

    by_year = (F.col("g_yr") == 0) & (F.col("g_prio") == 1) & (F.col("g_seg") == 1)
    by_prio = (F.col("g_yr") == 0) & (F.col("g_prio") == 0)
    by_seg_year = (F.col("g_yr") == 0) & (F.col("g_seg") == 0)
    generated = (
        F.when(by_year, F.array(
            row("demand", F.lit("Orders"), year_txt, F.col("n")),
            row("rates", F.lit("High value (rate)"), year_txt, _rate("h", "n")),
            row("rates", F.lit("Open (rate)"), year_txt, _rate("o", "n"))))
        .when(by_prio, F.array(
            row("demand", F.concat(F.lit("Orders - "), "prio", F.lit(" (number)")), year_txt,
                F.col("n")),
            row("demand", F.concat(F.lit("Orders - "), "prio", F.lit(" (value)")), year_txt,
                F.col("amt")),
            row("demand", F.concat(F.lit("Orders - "), "prio", F.lit(" (Q4 value)")), year_txt,
                F.col("q4"))))
        .when(by_seg_year, F.array(
            row("segments", F.concat(F.lit("Segment: "), "seg"), year_txt, F.col("n"))))
        .otherwise(F.array(
            row("segments", F.concat(F.lit("Segment: "), "seg"), F.lit("All years"), F.col("n")))))
    orders_rows = (fam.select("nk", F.inline(generated))
                   .withColumn("data_source", F.lit("orders"))
                   .select("dashboard_section", "nk", "timeframe", "characteristic", "indicator_value",
                           "data_source"))
    return _finish(spark, sf_dir, orders_rows.unionByName(_shipments(spark, sf_dir)))


# DuckDB twin of ``indicators`` for the oracle queries (a CTE named ind).
IND_SQL = f"""
geo AS (
  SELECT n_nationkey AS nk, n_name AS geography, CAST(n_nationkey AS VARCHAR) AS geography_id,
         r_name AS geography_type
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
cells AS (
  SELECT c_nationkey AS nk, year(o_orderdate) AS yr, o_orderpriority AS prio, c_mktsegment AS seg,
         count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amt,
         sum(CASE WHEN quarter(o_orderdate) = 4 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS q4,
         count_if(o_totalprice > {HIGH_VALUE}) AS n_high, count_if(o_orderstatus = 'O') AS n_open
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2, 3, 4
),
per_year AS (SELECT nk, yr, sum(n) AS n, sum(n_high) AS h, sum(n_open) AS o FROM cells GROUP BY nk, yr),
per_prio AS (SELECT nk, yr, prio, sum(n) AS n, sum(amt) AS amt, sum(q4) AS q4 FROM cells GROUP BY nk, yr, prio),
per_seg AS (SELECT nk, yr, seg, sum(n) AS n FROM cells GROUP BY nk, yr, seg),
per_seg_all AS (SELECT nk, seg, sum(n) AS n FROM cells GROUP BY nk, seg),
ship AS (
  SELECT s_nationkey AS nk, year(l_shipdate) AS yr, l_returnflag,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS q
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY 1, 2, 3
),
body AS (
  SELECT 'demand' AS dashboard_section, nk, 'Orders' AS characteristic, CAST(yr AS VARCHAR) AS timeframe,
         CAST(n AS DOUBLE) AS indicator_value, 'orders' AS data_source FROM per_year
  UNION ALL
  SELECT 'demand', nk, 'Orders - ' || prio || ' (number)', CAST(yr AS VARCHAR),
         CAST(n AS DOUBLE), 'orders' FROM per_prio
  UNION ALL
  SELECT 'demand', nk, 'Orders - ' || prio || ' (value)', CAST(yr AS VARCHAR),
         CAST(amt AS DOUBLE), 'orders' FROM per_prio
  UNION ALL
  SELECT 'demand', nk, 'Orders - ' || prio || ' (Q4 value)', CAST(yr AS VARCHAR),
         CAST(q4 AS DOUBLE), 'orders' FROM per_prio
  UNION ALL
  SELECT 'rates', nk, 'High value (rate)', CAST(yr AS VARCHAR),
         CAST((2000 * h + n) // (2 * n) AS DOUBLE) / 10, 'orders'
  FROM per_year
  UNION ALL
  SELECT 'rates', nk, 'Open (rate)', CAST(yr AS VARCHAR),
         CAST((2000 * o + n) // (2 * n) AS DOUBLE) / 10, 'orders'
  FROM per_year
  UNION ALL
  SELECT 'segments', nk, 'Segment: ' || seg, CAST(yr AS VARCHAR), CAST(n AS DOUBLE), 'orders' FROM per_seg
  UNION ALL
  SELECT 'segments', nk, 'Segment: ' || seg, 'All years', CAST(n AS DOUBLE), 'orders' FROM per_seg_all
  UNION ALL
  SELECT 'shipments', nk, 'Shipments - ' || l_returnflag, CAST(yr AS VARCHAR), CAST(q AS DOUBLE), 'lineitem'
  FROM ship
),
ind AS (
  SELECT dashboard_section, geography, geography_id, geography_type, characteristic, timeframe,
         indicator_value, data_source
  FROM body JOIN geo USING (nk)
)"""


# DuckDB twin of ``gap_indicators``.
GAP_IND_SQL = IND_SQL.replace("\nind AS (", "\nind_nations AS (") + """,
cust AS (
  SELECT 'orders' AS dashboard_section, o_custkey AS ck, 'Orders - ' || o_orderpriority AS characteristic,
         CAST(year(o_orderdate) AS VARCHAR) AS timeframe, CAST(count(*) AS DOUBLE) AS indicator_value, 'orders' AS data_source
  FROM orders GROUP BY ALL
  UNION ALL
  SELECT 'activity', user_id, 'Events - ' || event_type, CAST(year(ts) AS VARCHAR), CAST(count(*) AS DOUBLE), 'events'
  FROM events GROUP BY ALL
),
ind AS (
  SELECT * FROM ind_nations
  UNION ALL
  SELECT dashboard_section, c_name, CAST(c_custkey AS VARCHAR), c_mktsegment, characteristic, timeframe, indicator_value, data_source
  FROM cust JOIN customer ON ck = c_custkey
)"""


# Parsed year of the text period in oracle SQL (NULL for non-year periods).
YEAR_SQL = "CASE WHEN regexp_full_match(timeframe, '[0-9]{4}') THEN CAST(timeframe AS INTEGER) END"


def sql_str(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def with_ind(sql: str, ind_sql: str = IND_SQL) -> str:
    """Prefix an oracle query with the IND CTE chain (query may add CTEs)."""
    s = sql.strip()
    if s[:4].upper() == "WITH":
        return "WITH " + ind_sql + ",\n" + s[4:].lstrip()
    return "WITH " + ind_sql + "\n" + s


def with_gap_ind(sql: str) -> str:
    return with_ind(sql, GAP_IND_SQL)
