"""Sketch profiles, medians by selection, runs of absent periods and positions, over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.operators import runs, selection, sketch
from civicstat.operators.position import with_position
from civicstat.plans.registry import query
from civicstat.session import materialize
from civicstat.sources.tables import load

# ---- sketches: estimates from stored rows, each held against the exact count

_BOUND = sketch.bound()


def _held(df, key, distinct, **kw):
    """Estimates by ``key`` and in total, with exact counts and whether they agree within the bound."""
    stored = materialize(sketch.sketch_rows(df, [key], distinct, **kw))
    merged = sketch.estimates(sketch.merge_sketches(stored, [key], total="is_total"))
    exact = df.groupingSets([[key], []], key).agg(
        *[F.count_distinct(c).alias(f"exact_{n}") for n, c in distinct.items()], (F.grouping_id() > 0).alias("total"))
    exact = exact.withColumnRenamed(key, "of")
    j = merged.join(exact, merged[key].eqNullSafe(exact["of"]) & (merged["is_total"] == exact["total"]))
    for n in distinct:
        j = j.withColumn(f"{n}_within", F.abs(F.col(n) - F.col(f"exact_{n}")) <= _BOUND * F.col(f"exact_{n}"))
    names = [c for c in merged.columns if c not in distinct]
    return j.select(*names, *[F.col(f"exact_{n}").alias(n) for n in distinct], *[f"{n}_within" for n in distinct]).orderBy("is_total", key)


@query("sketch_profile_events", ids="A3 A5 A21", sql="""
SELECT event_type, count(*) AS row_count, CAST(count_if(value IS NULL) AS BIGINT) AS null_values,
       strftime(CAST(min(ts) AS DATE), '%Y-%m-%d') AS first_day, strftime(CAST(max(ts) AS DATE), '%Y-%m-%d') AS last_day,
       grouping(event_type) = 1 AS is_total, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days,
       true AS users_within, true AS days_within
FROM events GROUP BY ROLLUP (event_type) ORDER BY is_total, event_type
""")
def sketch_profile_events(spark, d):
    day = F.date_format(F.to_date("ts"), "yyyy-MM-dd")
    return _held(load(spark, d, "events"), "event_type", {"users": F.col("user_id"), "days": day}, value="value", extremes={"day": day})


@query("sketch_profile_lineitem", ids="A4 A21 G8", sql="""
SELECT l_returnflag, count(*) AS row_count, grouping(l_returnflag) = 1 AS is_total, count(DISTINCT l_orderkey) AS orders,
       count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers,
       true AS orders_within, true AS parts_within, true AS suppliers_within
FROM lineitem GROUP BY ROLLUP (l_returnflag) ORDER BY is_total, l_returnflag
""")
def sketch_profile_lineitem(spark, d):
    return _held(load(spark, d, "lineitem"), "l_returnflag",
                 {"orders": F.col("l_orderkey"), "parts": F.col("l_partkey"), "suppliers": F.col("l_suppkey")})


# ---- medians

_MEDIANS = (("lineitem", "l_extendedprice"), ("lineitem", "l_quantity"), ("orders", "o_totalprice"), ("events", "value"))


@query("exact_medians", ids="A15", sql="\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, median({c}) AS median FROM {t}" for t, c in _MEDIANS) + "\nORDER BY 1, 2")
def exact_medians(spark, d):
    found = [(t, c, selection.exact_median(load(spark, d, t), c)) for t, c in _MEDIANS]
    return spark.createDataFrame(found, "table_name string, column_name string, median double").orderBy("table_name", "column_name")


@query("above_median_lines", ids="A15 O4", sql="""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_extendedprice > (SELECT median(l_extendedprice) FROM lineitem) AS above_median
FROM lineitem
""")
def above_median_lines(spark, d):
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return selection.above_exact_median(lines, "l_extendedprice")


# ---- runs of absent periods

@query("gap_runs_customers", ids="G1 G9", sql="""
WITH p AS (SELECT DISTINCT o_custkey AS ck, year(o_orderdate) AS y FROM orders),
e AS (SELECT min(y) AS lo, max(y) AS hi FROM p),
s AS (SELECT ck, min(y) AS a, max(y) AS b FROM p GROUP BY ck),
r AS (
  SELECT ck, 'inner' AS place, y + 1 AS f, nxt - 1 AS l FROM (SELECT ck, y, lead(y) OVER (PARTITION BY ck ORDER BY y) AS nxt FROM p) WHERE nxt > y + 1
  UNION ALL SELECT ck, 'leading', lo, a - 1 FROM s, e WHERE a > lo
  UNION ALL SELECT ck, 'trailing', b + 1, hi FROM s, e WHERE b < hi
  UNION ALL SELECT c_custkey, 'whole', lo, hi FROM customer, e WHERE c_custkey NOT IN (SELECT ck FROM p))
SELECT c_name, place, CAST(f AS BIGINT) AS first, CAST(l AS BIGINT) AS last, CAST(l - f + 1 AS BIGINT) AS length,
       CASE WHEN f = l THEN CAST(f AS VARCHAR) ELSE CAST(f AS VARCHAR) || ' to ' || CAST(l AS VARCHAR) END AS years
FROM r JOIN customer ON ck = c_custkey ORDER BY c_name, first
""")
def gap_runs_customers(spark, d):
    """Years without an order of each customer, as ranges; trailing ones make a stale series."""
    orders = load(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    customer = load(spark, d, "customer").select("c_custkey", "c_name")
    gaps = runs.absent_runs(orders, ["c_custkey"], F.year("o_orderdate"), series=customer)
    return (gaps.withColumn("years", runs.range_text()).join(customer, "c_custkey").drop("c_custkey")
            .select("c_name", "place", "first", "last", "length", "years").orderBy("c_name", "first"))


@query("present_runs_events", ids="G4", sql="""
WITH p AS (SELECT DISTINCT user_id, event_type, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) // 86400000 AS day FROM events),
g AS (SELECT *, day - row_number() OVER (PARTITION BY user_id, event_type ORDER BY day) AS run FROM p)
SELECT user_id, event_type, CAST(min(day) AS BIGINT) AS first, CAST(max(day) AS BIGINT) AS last, count(*) AS length
FROM g GROUP BY user_id, event_type, run
""")
def present_runs_events(spark, d):
    """Runs of days (since 1970) on which a user has events of a type."""
    return runs.present_runs(load(spark, d, "events"), ["user_id", "event_type"], F.unix_date(F.to_date("ts")))


# ---- positions

_C = F.col


@query("position_multi_key", ids="O1", sql="""
SELECT o_orderkey, o_orderpriority, o_totalprice,
       row_number() OVER (ORDER BY o_orderpriority ASC, o_totalprice DESC, o_orderkey ASC) AS position FROM orders
""")
def position_multi_key(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return with_position(o, [_C("o_orderpriority").asc(), _C("o_totalprice").desc(), _C("o_orderkey").asc()])


@query("position_alias", ids="O3 O4", sql="""
SELECT l_partkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity, count(*) AS n_lines,
       row_number() OVER (ORDER BY sum(CAST(l_quantity AS DECIMAL(18,2))) DESC, l_partkey) AS position
FROM lineitem GROUP BY l_partkey
""")
def position_alias(spark, d):
    totals = load(spark, d, "lineitem").groupBy("l_partkey").agg(
        F.sum(_C("l_quantity").cast("decimal(18,2)")).cast("double").alias("total_quantity"), F.count(F.lit(1)).alias("n_lines"))
    return with_position(totals, [_C("total_quantity").desc(), _C("l_partkey").asc()])


_FLAGS = ("A", "N", "R")


@query("position_pivot_column", ids="O5 A19", sql=f"""
WITH p AS (SELECT l_suppkey, {", ".join(f"count_if(l_returnflag = '{x}') AS {x}" for x in _FLAGS)} FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, {", ".join(f"CAST({x} AS BIGINT) AS {x}" for x in _FLAGS)},
       row_number() OVER (ORDER BY R DESC, l_suppkey) AS position FROM p
""")
def position_pivot_column(spark, d):
    wide = load(spark, d, "lineitem").groupBy("l_suppkey").pivot("l_returnflag", list(_FLAGS)).agg(F.count(F.lit(1))).na.fill(0)
    return with_position(wide, [_C("R").desc(), _C("l_suppkey").asc()])


@query("position_latest_value", ids="O7 W1", sql="""
WITH l AS (SELECT user_id, max({'ts': ts, 'id': event_id, 'v': value}) AS m FROM events GROUP BY user_id)
SELECT user_id, m.id AS event_id, m.v AS value, row_number() OVER (ORDER BY m.v DESC NULLS LAST, user_id) AS position FROM l
""")
def position_latest_value(spark, d):
    last = load(spark, d, "events").groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "value")).alias("m"))
    rows = last.select("user_id", _C("m.event_id").alias("event_id"), _C("m.value").alias("value"))
    return with_position(rows, [_C("value").desc_nulls_last(), _C("user_id").asc()])


@query("position_text_number", ids="O8 P16", sql=r"""
WITH t AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN 'n/a' ELSE CAST(n_chars AS VARCHAR) END AS size_text FROM documents)
SELECT doc_id, size_text, row_number() OVER (ORDER BY TRY_CAST(size_text AS DOUBLE) DESC NULLS LAST, doc_id) AS position FROM t
""")
def position_text_number(spark, d):
    """Sizes as text, some of them no number, in the order of the numbers and not of the text."""
    size = F.when(_C("n_chars") % 7 == 0, "n/a").otherwise(_C("n_chars").cast("string"))
    t = load(spark, d, "documents").select("doc_id", size.alias("size_text"))
    return with_position(t, [F.try_to_number("size_text", F.lit("999999999999")).cast("double").desc_nulls_last(), _C("doc_id").asc()])
