"""Validator (C1-C10) run on the driver tables and IND.

Analogues of the reference's categories: fixed-size dimensions and ratio
row counts (C1), key sets with a boolean-flag filter (C2), foreign keys
between the facts (C3), NULLs in key columns and IND (C4), inline truth
values per region and IND rates recomputed from orders (C5), cross-table
totals (C6), reference use (C7), spot checks (C8), naming (C9), and the
summary / confidence tiers (C10).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.operators import longform as L
from civicstat.operators import quality as Q
from civicstat.operators import star
from civicstat.operators.scan import Count, Lookup, scan_once
from civicstat.plans.indicators import build_indicators_single_scan, indicators, order_cells, with_ind, IND_SQL, sql_str
from civicstat.plans.registry import query
from civicstat.session import materialize
from civicstat.sources.expected import truth_frame
from civicstat.sources.tables import load

# ---------------------------------------------------------------- helpers


def sql_check(category, check_name, subject="NULL", column="NULL", status="NULL",
              actual="NULL", expected="NULL", diff="NULL", detail="NULL") -> str:
    """SELECT list of a check row in SQL (arguments are SQL expressions)."""
    return (f"CAST({category} AS VARCHAR) AS category, CAST({check_name} AS VARCHAR) AS check_name, "
            f"CAST({subject} AS VARCHAR) AS subject, CAST({column} AS VARCHAR) AS \"column\", "
            f"CAST({status} AS VARCHAR) AS status, CAST({actual} AS DOUBLE) AS actual, "
            f"CAST({expected} AS DOUBLE) AS expected, CAST({diff} AS DOUBLE) AS diff, "
            f"CAST({detail} AS VARCHAR) AS detail")


_q = sql_str


def _tol_sql(a: str, e: str, frac: str) -> str:
    return (f"CASE WHEN {a} IS NULL OR isnan({a}) THEN false WHEN {frac} THEN abs({a} - {e}) < 0.15 "
            f"ELSE coalesce(trunc({a}) = trunc({e}), false) END")


_BODIES: dict[str, str] = {}     # check SQL bodies (may reference ind), reused by the summary


def _register_sql(name: str, body: str, uses_ind: bool = False) -> str:
    _BODIES[name] = body
    return with_ind(body) if uses_ind else body


# ------------------------------------------------------------------ C1

COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
FIXED_COUNTS = {"region": 5, "nation": 25, "timeframe_dim": 20}
# expected = factor x actual rows of another table (hold at every scale factor)
RATIO_COUNTS = (("orders", 10, "customer"), ("lineitem", 4, "orders"),
                ("part", 20, "supplier"), ("customer", 15, "supplier"))

_ROWCOUNT_SQL = _register_sql("dq_row_counts", "WITH counts AS (\n  " + "\n  UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS actual_rows FROM {t}" for t in COUNTED) + "\n),\nexpected AS (\n  "
    + "\n  UNION ALL ".join([f"SELECT '{k}' AS table_name, CAST({v} AS BIGINT) AS expected_rows"
                             for k, v in FIXED_COUNTS.items()]
                            + [f"SELECT '{t}', {f} * actual_rows FROM counts WHERE table_name = '{src}'"
                               for t, f, src in RATIO_COUNTS]) + "\n)\nSELECT " + sql_check(
    "'1-rowcounts'", "e.table_name", status="CASE WHEN c.actual_rows IS NULL THEN 'MISSING' "
    "WHEN c.actual_rows = e.expected_rows THEN 'PASS' ELSE 'FAIL' END",
    actual="c.actual_rows", expected="e.expected_rows", diff="abs(c.actual_rows - e.expected_rows)",
    detail="CASE WHEN c.actual_rows IS NULL THEN 'table not found' WHEN c.actual_rows <> e.expected_rows "
    "THEN 'actual=' || CAST(c.actual_rows AS VARCHAR) || ' expected=' || CAST(e.expected_rows AS VARCHAR) END")
    + "\nFROM expected e LEFT JOIN counts c ON e.table_name = c.table_name")


def row_count_checks(spark, d, counts=None):
    counts = Q.table_counts({t: load(spark, d, t) for t in COUNTED}) if counts is None else counts
    fixed = spark.createDataFrame([(k, v) for k, v in FIXED_COUNTS.items()],
                                  "table_name string, expected_rows bigint").coalesce(1)
    ratios = [counts.filter(F.col("table_name") == src).select(
        F.lit(t).alias("table_name"), (F.col("actual_rows") * f).alias("expected_rows"))
        for t, f, src in RATIO_COUNTS]
    expected = fixed
    for r in ratios:
        expected = expected.unionByName(r)
    return Q.row_count_checks(counts, expected)


@query("dq_row_counts", ids="C1 A1 U1 S7", sql=_ROWCOUNT_SQL)
def dq_row_counts(spark, d):
    return row_count_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C2

EXPECTED_REGION0_KEYS = (0, 5, 10, 15, 20, 25)

_KEYSET_SQL = _register_sql("dq_key_set", f"""
WITH a AS (SELECT DISTINCT n_nationkey AS k FROM (SELECT n_nationkey, n_regionkey = 0 AS in_first_region
           FROM nation) WHERE in_first_region),
e AS (SELECT * FROM (VALUES {", ".join(f"({k})" for k in EXPECTED_REGION0_KEYS)}) t(k)),
s AS (SELECT count(a.k) AS n_actual, count(e.k) AS n_expected, count_if(a.k IS NULL) AS n_missing,
             count_if(e.k IS NULL) AS n_extra FROM e FULL OUTER JOIN a ON e.k = a.k)
SELECT {sql_check("'2-dims'", "'first-region nation keys'", column="'n_nationkey'",
                  status="CASE WHEN n_missing = 0 AND n_extra = 0 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n_actual", expected="n_expected", diff="n_missing + n_extra",
                  detail="CASE WHEN NOT (n_missing = 0 AND n_extra = 0) THEN 'missing=' || "
                         "CAST(n_missing AS VARCHAR) || ' extra=' || CAST(n_extra AS VARCHAR) END")} FROM s
UNION ALL
SELECT {sql_check("'2-dims'", "'region count'", status="CASE WHEN n = 5 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n", expected="5", diff="abs(n - 5)",
                  detail="CASE WHEN n <> 5 THEN 'actual=' || CAST(n AS VARCHAR) END")}
FROM (SELECT count(*) AS n FROM region)
UNION ALL
SELECT {sql_check("'2-dims'", "'nation count'", status="CASE WHEN n = 25 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n", expected="25", diff="abs(n - 25)",
                  detail="CASE WHEN n <> 25 THEN 'actual=' || CAST(n AS VARCHAR) END")}
FROM (SELECT count(*) AS n FROM nation)
""")


def first_region_check(spark, d):
    nation = load(spark, d, "nation").withColumn("in_first_region", F.col("n_regionkey") == 0)
    actual = nation.filter(F.col("in_first_region")).select(F.col("n_nationkey").alias("k"))
    expected = spark.createDataFrame([(k,) for k in EXPECTED_REGION0_KEYS], "k int").coalesce(1)
    return Q.key_set_check(actual, expected, "k", "first-region nation keys").withColumn("column", F.lit("n_nationkey"))


def key_set_checks(spark, d):
    return Q.union_checks([
        first_region_check(spark, d),
        Q.count_check(load(spark, d, "region"), 5, "region count"),
        Q.count_check(load(spark, d, "nation"), 25, "nation count"),
    ])


@query("dq_key_set", ids="C2 J6 P14 A1", sql=_KEYSET_SQL)
def dq_key_set(spark, d):
    return key_set_checks(spark, d).orderBy("check_name")


@query("dq_key_status", ids="J6 U3", sql=f"""
WITH a AS (SELECT DISTINCT n_nationkey AS k FROM nation WHERE n_regionkey = 0),
e AS (SELECT * FROM (VALUES {", ".join(f"({k})" for k in EXPECTED_REGION0_KEYS)}) t(k))
SELECT coalesce(e.k, a.k) AS k,
       CASE WHEN a.k IS NULL THEN 'MISSING' WHEN e.k IS NULL THEN 'EXTRA' ELSE 'OK' END AS status
FROM e FULL OUTER JOIN a ON e.k = a.k ORDER BY k
""")
def dq_key_status(spark, d):
    from civicstat.operators.star import key_set_diff
    nation = load(spark, d, "nation").filter(F.col("n_regionkey") == 0).select(F.col("n_nationkey").alias("k"))
    expected = spark.createDataFrame([(k,) for k in EXPECTED_REGION0_KEYS], "k int").coalesce(1)
    return key_set_diff(nation, expected, "k").orderBy("k")


# ------------------------------------------------------------------ C3

FK_PAIRS = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
    ("documents", "doc_id", "labels", "doc_id"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
)

_ORPHAN_SQL = _register_sql("dq_orphans", "\nUNION ALL\n".join(
    f"SELECT {sql_check(chr(39) + '3-fk' + chr(39), _q(f'{f}->{dt}'), _q(f), _q(fk), "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END", 'n', '0', 'n', "CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || ' orphan rows' END")}\n"
    f"FROM (SELECT count(*) AS n FROM {f} x LEFT JOIN (SELECT DISTINCT {dk} AS k FROM {dt}) d ON x.{fk} = d.k "
    f"WHERE d.k IS NULL)"
    for f, fk, dt, dk in FK_PAIRS))


def _pairs(spark, d):
    return [(f, load(spark, d, f), fk, dt, load(spark, d, dt), dk) for f, fk, dt, dk in FK_PAIRS]


def orphan_checks(spark, d):
    return Q.orphan_checks(_pairs(spark, d))


def orphan_checks_one_scan(spark, d):
    return Q.orphan_checks_one_scan(_pairs(spark, d))


@query("dq_orphans", ids="C3 J3", sql=_ORPHAN_SQL)
def dq_orphans(spark, d):
    return orphan_checks(spark, d).orderBy("check_name")


@query("dq_orphans_one_scan", ids="C3 J3", sql=_ORPHAN_SQL)
def dq_orphans_one_scan(spark, d):
    """The same rows; lineitem is scanned once for its three keys."""
    return orphan_checks_one_scan(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C4

NULL_COLUMNS = {
    "customer": ("c_nationkey", "c_acctbal", "c_mktsegment"),
    "orders": ("o_custkey", "o_orderdate", "o_totalprice"),
    "lineitem": ("l_orderkey", "l_suppkey", "l_shipdate"),
    "documents": ("doc_id", "source"),      # key columns, as C4 checks; never scans the document texts
    "ind": ("geography_id", "indicator_value"),
}

_NULL_SQL = _register_sql("dq_nulls", "\nUNION ALL\n".join(
    f"SELECT {sql_check(chr(39) + '4-nulls' + chr(39), _q(f'{t}.{c}'), _q(t), _q(c), "CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END", 'n', '0', 'n', "CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || ' NULLs' END")}\n"
    f"FROM (SELECT count_if({c} IS NULL) AS n FROM {t})"
    for t, cols in NULL_COLUMNS.items() for c in cols), uses_ind=True)


def null_checks(spark, d, ind=None):
    ind = indicators(spark, d, single_scan=True) if ind is None else ind
    frames = {t: (ind if t == "ind" else load(spark, d, t), cols)
              for t, cols in NULL_COLUMNS.items()}
    return Q.null_checks(frames)


@query("dq_nulls", ids="C4 A6", sql=with_ind(_BODIES["dq_nulls"]))
def dq_nulls(spark, d):
    return null_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C5

# Inline expectations per region (subject -> column -> expected value).
# Integral values compare by truncation, fractional ones within 0.15.
REGION_TRUTH = {
    "AFRICA": {"n_nations": 5, "cust_share_pct": 20.1},
    "AMERICA": {"n_nations": 5, "cust_share_pct": 20},
    "ASIA": {"n_nations": 5.0, "cust_share_pct": 19.9},
    "EUROPE": {"n_nations": 5, "cust_share_pct": 20.5},
    "MIDDLE EAST": {"n_nations": 6, "cust_share_pct": 19.5},
    "ANTARCTICA": {"n_nations": 1},
}
VERIFIED_SUBJECTS = ("AFRICA", "ASIA")


def _truth_values_sql(truth) -> str:
    rows = []
    for s, cols in truth.items():
        for c, v in cols.items():
            frac = "true" if isinstance(v, float) and not float(v).is_integer() else "false"
            rows.append(f"({_q(s)}, {_q(c)}, CAST({float(v)!r} AS DOUBLE), {frac})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(subject, \"column\", expected, is_fractional)"


_TRUTH_SQL = _register_sql("dq_truth_compare", f"""
WITH tot AS (SELECT count(*) AS total FROM customer),
per AS (
  SELECT r_name AS subject, CAST(count(DISTINCT n_nationkey) AS DOUBLE) AS n_nations FROM nation
  JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
),
cust AS (
  SELECT r_name AS subject, CAST(count(*) AS DOUBLE) * 100.0 / CAST((SELECT total FROM tot) AS DOUBLE)
         AS cust_share_pct
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name
),
wide AS (SELECT per.subject, n_nations, cust_share_pct FROM per LEFT JOIN cust ON per.subject = cust.subject),
long AS (
  SELECT subject, 'n_nations' AS "column", n_nations AS actual FROM wide
  UNION ALL SELECT subject, 'cust_share_pct', cust_share_pct FROM wide
),
truth AS ({_truth_values_sql(REGION_TRUTH)}),
j AS (
  SELECT t.subject, t."column", t.expected, t.is_fractional, l.actual,
         (SELECT count(*) FROM wide w WHERE w.subject = t.subject) > 0 AS seen
  FROM truth t LEFT JOIN long l ON t.subject = l.subject AND t."column" = l."column"
)
SELECT {sql_check("'5-truth-regions'", "subject || '.' || \"column\"", "subject", '"column"',
                  "CASE WHEN NOT seen THEN 'MISSING' WHEN " + _tol_sql("actual", "expected", "is_fractional")
                  + " THEN 'PASS' ELSE 'FAIL' END", "actual", "expected", "abs(actual - expected)",
                  "CASE WHEN NOT seen THEN 'no actual row' WHEN actual IS NULL THEN 'actual=NULL' END")}
FROM j
""")


def customers_by_nation(spark, d):
    return load(spark, d, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


def truth_compare_checks(spark, d, sizes=None):
    sizes = customers_by_nation(spark, d) if sizes is None else sizes
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    per = geo.groupBy(F.col("r_name").alias("subject")).agg(
        F.count_distinct("n_nationkey").cast("double").alias("n_nations"))
    total = sizes.select(F.sum("n").cast("double")).scalar()
    cust = (sizes.join(geo, sizes.c_nationkey == geo.n_nationkey)
            .groupBy(F.col("r_name").alias("subject"))
            .agg((F.sum("n").cast("double") * F.lit(100.0) / total).alias("cust_share_pct")))
    wide = per.join(cust, "subject", "left")
    truth = truth_frame(spark, REGION_TRUTH)
    return Q.truth_checks(wide, truth, "subject", ["n_nations", "cust_share_pct"], "5-truth-regions")


@query("dq_truth_compare", ids="C5 J7 F11 S8", sql=_TRUTH_SQL)
def dq_truth_compare(spark, d):
    return truth_compare_checks(spark, d).orderBy("check_name")


_TOL_SQL = _register_sql("dq_tolerance_rules", f"""
WITH raw AS (
  SELECT n_name AS subject, CAST(year(o_orderdate) AS VARCHAR) AS period, count(*) AS n,
         count_if(o_orderstatus = 'O') AS n_open
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2
),
truth AS (
  SELECT subject, period, 'open_rate' AS "column", CAST(n_open AS DOUBLE) * 100.0 / CAST(n AS DOUBLE) AS expected
  FROM raw
  UNION ALL
  SELECT subject, period, 'orders', CAST(n AS DOUBLE) FROM raw
),
wide AS (
  SELECT geography AS subject, timeframe AS period,
         max(CASE WHEN characteristic = 'Open (rate)' THEN indicator_value END) AS open_rate,
         max(CASE WHEN characteristic = 'Orders' THEN indicator_value END) AS orders
  FROM ind WHERE characteristic IN ('Open (rate)', 'Orders')
  GROUP BY geography, timeframe
),
long AS (
  SELECT subject, period, 'open_rate' AS "column", open_rate AS actual FROM wide
  UNION ALL SELECT subject, period, 'orders', orders FROM wide
),
j AS (
  SELECT t.*, t.expected <> floor(t.expected) AS is_fractional, l.actual,
         EXISTS (SELECT 1 FROM wide w WHERE w.subject = t.subject AND w.period = t.period) AS seen
  FROM truth t LEFT JOIN long l ON t.subject = l.subject AND t.period = l.period AND t."column" = l."column"
)
SELECT {sql_check("'5-truth-rates'", "subject || '.' || period || '.' || \"column\"", "subject", '"column"',
                  "CASE WHEN NOT seen THEN 'MISSING' WHEN " + _tol_sql("actual", "expected", "is_fractional")
                  + " THEN 'PASS' ELSE 'FAIL' END", "actual", "expected", "abs(actual - expected)",
                  "CASE WHEN NOT seen THEN 'no actual row' WHEN actual IS NULL THEN 'actual=NULL' END")}
FROM j
""", uses_ind=True)


def order_counts(spark, d, cells=None):
    """(nk, yr, n, n_open): orders by nation and year, from rows or from IND's cells."""
    if cells is not None:
        return cells.groupBy("nk", "yr").agg(F.sum("n").alias("n"), F.sum("o").alias("n_open"))
    orders = load(spark, d, "orders").select("o_custkey", "o_orderstatus", F.year("o_orderdate").alias("yr"))
    customer = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nk"))
    return orders.join(customer, orders.o_custkey == customer.c_custkey).groupBy("nk", "yr").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "O").alias("n_open"))


def tolerance_rule_checks(spark, d, ind=None, cells=None):
    """IND's rounded rates and counts against values recomputed from orders."""
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("nk"), "n_name")
    raw = (order_counts(spark, d, cells).join(nation, "nk")
           .groupBy(F.col("n_name").alias("subject"), F.col("yr").cast("string").alias("period"))
           .agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open")))
    truth = raw.select("subject", "period",
                       (F.col("n_open").cast("double") * F.lit(100.0) / F.col("n").cast("double")).alias("open_rate"),
                       F.col("n").cast("double").alias("orders")) \
               .unpivot(["subject", "period"], ["open_rate", "orders"], "column", "expected") \
               .withColumn("is_fractional", F.col("expected") != F.floor("expected"))
    ind = L.select_indicators(indicators(spark, d, single_scan=True) if ind is None else ind,
                              characteristics=["Open (rate)", "Orders"])
    from civicstat.operators.reshape import pivot_unique
    wide = pivot_unique(ind, ["geography", "timeframe"], "characteristic", "indicator_value",
                        ["Open (rate)", "Orders"], aliases=["open_rate", "orders"])
    return Q.truth_checks(wide, truth, "geography", ["open_rate", "orders"], "5-truth-rates", period="timeframe")


@query("dq_tolerance_rules", ids="C5 F11 F10 J7", sql=with_ind(_BODIES["dq_tolerance_rules"]))
def dq_tolerance_rules(spark, d):
    return tolerance_rule_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C6

_TOTAL_SQL = _register_sql("dq_total_equal", f"""
WITH l AS (SELECT geography AS subject, sum(indicator_value) AS v FROM ind
           WHERE characteristic LIKE 'Segment: %' AND timeframe = 'All years' GROUP BY geography),
r AS (SELECT n_name AS subject, CAST(count(*) AS DOUBLE) AS v
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
j AS (SELECT coalesce(l.subject, r.subject) AS subject, l.v AS lv, r.v AS rv FROM l FULL OUTER JOIN r
      ON l.subject = r.subject)
SELECT {sql_check("'6-consistency'", "subject || ': segments total = orders'", "subject", "NULL",
                  "CASE WHEN lv IS NULL OR rv IS NULL THEN 'MISSING' WHEN trunc(lv) = trunc(rv) THEN 'PASS' "
                  "ELSE 'FAIL' END", "lv", "rv", "abs(trunc(lv) - trunc(rv))")}
FROM j
""", uses_ind=True)


def total_equal_checks(spark, d, ind=None, cells=None):
    ind = indicators(spark, d) if ind is None else ind
    left = (L.select_indicators(ind, like="Segment: %", periods=["All years"])
            .groupBy("geography").agg(F.sum("indicator_value").alias("value")))
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("nk"), "n_name")
    right = (order_counts(spark, d, cells).join(nation, "nk").groupBy(F.col("n_name").alias("geography"))
             .agg(F.sum("n").cast("double").alias("value")))
    return Q.equal_totals_check(left, right, "geography", "segments total = orders")


@query("dq_total_equal", ids="C6 J2 F10", sql=with_ind(_BODIES["dq_total_equal"]))
def dq_total_equal(spark, d):
    return total_equal_checks(spark, d).orderBy("check_name")


_SUM_SQL = _register_sql("dq_sum_close", f"""
WITH p AS (SELECT geography || '|' || timeframe AS subject, sum(indicator_value) AS pv FROM ind
           WHERE characteristic LIKE 'Orders - %(number)' GROUP BY 1),
w AS (SELECT geography || '|' || timeframe AS subject, indicator_value AS wv FROM ind
      WHERE characteristic = 'Orders'),
j AS (SELECT w.subject, pv, wv, abs(trunc(pv) - trunc(wv)) AS diff FROM w LEFT JOIN p ON w.subject = p.subject)
SELECT {sql_check("'6-consistency'", "subject || ': priority parts ~= orders'", "subject", "NULL",
                  "CASE WHEN pv IS NULL OR wv IS NULL THEN 'MISSING' WHEN diff <= 10 THEN 'PASS' ELSE 'FAIL' END",
                  "pv", "wv", "diff", "CASE WHEN diff > 10 THEN 'diff=' || CAST(CAST(diff AS BIGINT) AS VARCHAR) END")}
FROM j
""", uses_ind=True)


def sum_close_checks(spark, d, ind=None):
    ind = indicators(spark, d) if ind is None else ind
    cols = ["geography", "timeframe", F.col("indicator_value").alias("value")]
    parts = L.select_indicators(ind, like="Orders - %(number)").select(*cols)
    whole = L.select_indicators(ind, characteristics=["Orders"]).select(*cols)
    return Q.sum_close_check(parts, whole, ["geography", "timeframe"], "priority parts ~= orders", bound=10)


@query("dq_sum_close", ids="C6 A10 F13", sql=with_ind(_BODIES["dq_sum_close"]))
def dq_sum_close(spark, d):
    return sum_close_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C7

_UNUSED_SQL = _register_sql("dq_unused_refs", f"""
WITH refs AS (SELECT s_nationkey AS k FROM supplier
              UNION SELECT c_nationkey FROM customer),
a AS (SELECT count_if(refs.k IS NULL) AS unused FROM (SELECT DISTINCT n_nationkey FROM nation) d
      LEFT JOIN refs ON d.n_nationkey = refs.k)
SELECT {sql_check("'7-traceability'", "'all nations referenced'", "NULL", "'n_nationkey'",
                  "CASE WHEN unused = 0 THEN 'PASS' ELSE 'FAIL' END", "unused", "0", "unused",
                  "CASE WHEN unused > 0 THEN 'unused=' || CAST(unused AS VARCHAR) END")}
FROM a
""")


def unused_ref_checks(spark, d):
    nation = load(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    s = load(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    c = load(spark, d, "customer").select(F.col("c_nationkey").alias("k"))
    return Q.unused_refs_check(nation, [s, c], "k", "all nations referenced").withColumn(
        "column", F.lit("n_nationkey"))


@query("dq_unused_refs", ids="C7 U2 J4", sql=_UNUSED_SQL)
def dq_unused_refs(spark, d):
    return unused_ref_checks(spark, d)


# ------------------------------------------------------------------ C8

_SPOT_SQL = _register_sql("dq_spot", f"""
WITH last AS (SELECT count(*) AS n, count(indicator_value) AS n_values FROM ind
         WHERE characteristic LIKE 'Orders - %(Q4 value)' AND timeframe = '2001'),
small AS (SELECT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey
          ORDER BY count(*), n_nationkey LIMIT 2),
present AS (SELECT count(*) AS n FROM ind WHERE dashboard_section = 'rates'
            AND geography IN (SELECT n_name FROM small)),
neg AS (SELECT count(*) AS n FROM lineitem WHERE l_quantity <= 0)
SELECT {sql_check("'8-spot'", "'unfinished year present'", status="CASE WHEN n >= 1 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n", expected="1", detail="CASE WHEN NOT (n >= 1) THEN 'rows=' || CAST(n AS VARCHAR) END")}
FROM last
UNION ALL
SELECT {sql_check("'8-spot'", "'no fourth quarter in an unfinished year'", status="CASE WHEN n_values <= 0 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n_values", expected="0", detail="CASE WHEN NOT (n_values <= 0) THEN 'rows=' || CAST(n_values AS VARCHAR) END")}
FROM last
UNION ALL
SELECT {sql_check("'8-spot'", "'smallest communities present'", status="CASE WHEN n >= 1 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n", expected="1", detail="CASE WHEN NOT (n >= 1) THEN 'rows=' || CAST(n AS VARCHAR) END")}
FROM present
UNION ALL
SELECT {sql_check("'8-spot'", "'no non-positive quantities'", status="CASE WHEN n <= 0 THEN 'PASS' ELSE 'FAIL' END",
                  actual="n", expected="0", detail="CASE WHEN NOT (n <= 0) THEN 'rows=' || CAST(n AS VARCHAR) END")}
FROM neg
""", uses_ind=True)


def spot_checks(spark, d, ind=None, sizes=None, negative=None):
    ind = indicators(spark, d, single_scan=True) if ind is None else ind
    last = L.select_indicators(ind, like="Orders - %(Q4 value)", periods=["2001"])
    nation = load(spark, d, "nation").select("n_nationkey", "n_name")
    sizes = customers_by_nation(spark, d) if sizes is None else sizes
    named = sizes.join(nation, sizes.c_nationkey == nation.n_nationkey)
    smallest = named.orderBy("n", "n_nationkey").limit(2).select(F.col("n_name").alias("geography"))
    present = L.select_indicators(ind, section="rates").join(F.broadcast(smallest), "geography", "left_semi")
    if negative is None:
        negative = load(spark, d, "lineitem").filter(F.col("l_quantity") <= 0).agg(F.count(F.lit(1)).alias("n"))
    return Q.union_checks([
        Q.expect_rows(last, "unfinished year present", minimum=1),
        Q.expect_rows(last.filter(F.col("indicator_value").isNotNull()), "no fourth quarter in an unfinished year",
                      maximum=0),
        Q.expect_rows(present, "smallest communities present", minimum=1),
        Q.bound_rows(negative, "no non-positive quantities", maximum=0),
    ])


@query("dq_spot", ids="C8 P18", sql=with_ind(_BODIES["dq_spot"]))
def dq_spot(spark, d):
    return spot_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C9

# Names of geography rows are words in capitals, digits and underscores; the names of customers
# and suppliers are a word, # and nine digits.
NAME_PATTERN = r"^[A-Z]+([ _][A-Z0-9]+)*$"
NUMBERED = (("customer", "c_name", "^Customer#[0-9]{9}$"), ("supplier", "s_name", "^Supplier#[0-9]{9}$"))
NO_COMMENTS = "parquet folders carry no comments"

_NAMES_SQL = _register_sql("dq_names", f"""
WITH names AS (SELECT n_name AS table_name FROM nation UNION SELECT r_name FROM region)
SELECT {sql_check("'9-standards'", "'naming: ' || table_name", "table_name", "NULL",
                  f"CASE WHEN regexp_matches(table_name, '{NAME_PATTERN}') THEN 'PASS' ELSE 'FAIL' END",
                  detail=f"CASE WHEN NOT regexp_matches(table_name, '{NAME_PATTERN}') THEN 'pattern {NAME_PATTERN}' END")}
FROM names
""" + "".join(f"""UNION ALL
SELECT {sql_check("'9-standards'", f"'names of {t}'", status="CASE WHEN n <= 0 THEN 'PASS' ELSE 'FAIL' END", actual="n", expected="0",
                  detail="CASE WHEN NOT (n <= 0) THEN 'rows=' || CAST(n AS VARCHAR) END")}
FROM (SELECT count(*) AS n FROM {t} WHERE NOT coalesce(regexp_matches({c}, '{r}'), FALSE))
""" for t, c, r in NUMBERED) + f"""UNION ALL
SELECT {sql_check("'9-standards'", "'comments'", status="'SKIPPED'", detail=f"'{NO_COMMENTS}'")}
""")


def misnamed(column, pattern):
    return ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def naming_checks(spark, d, wrong=None):
    """C9 on the given tables: every name follows its pattern; comments can't be checked on parquet.

    ``wrong(table)`` gives a frame (n) of the names off their pattern.
    """
    wrong = wrong or (lambda t: load(spark, d, t).filter(misnamed(*patterns[t])).agg(F.count(F.lit(1)).alias("n")))
    patterns = {t: (c, r) for t, c, r in NUMBERED}
    names = star.union_distinct([load(spark, d, "nation").select(F.col("n_name").alias("table_name")),
                                 load(spark, d, "region").select(F.col("r_name").alias("table_name"))])
    numbered = [Q.bound_rows(wrong(t), f"names of {t}", maximum=0, category="9-standards") for t in patterns]
    return Q.union_checks([Q.naming_checks(names, NAME_PATTERN), *numbered,
                           Q.skipped(spark, "9-standards", ["comments"], NO_COMMENTS)])


@query("dq_names", ids="C9 S7", sql=_NAMES_SQL)
def dq_names(spark, d):
    return naming_checks(spark, d).orderBy("check_name")


# ------------------------------------------------------------------ C10

_ALL = ("dq_row_counts", "dq_key_set", "dq_orphans", "dq_nulls", "dq_truth_compare", "dq_tolerance_rules",
        "dq_total_equal", "dq_sum_close", "dq_unused_refs", "dq_spot", "dq_names")


def asked(nulls=NULL_COLUMNS):
    """What C1, C3, C4, C7, C8 and C9 count in whole tables."""
    return [
        *[Count("rows", t) for t in COUNTED],
        *[Count("nulls", t, c, F.col(c).isNull()) for t, cols in nulls.items() for c in cols],
        *[Lookup("orphans", f"{f}->{t}", (f, fk), [(t, k)]) for f, fk, t, k in FK_PAIRS],
        Lookup("unused", "nation", ("nation", "n_nationkey"), [("supplier", "s_nationkey"), ("customer", "c_nationkey")], distinct=True),
        Count("negative", "lineitem", "l_quantity", F.col("l_quantity") <= 0),
        *[Count("misnamed", t, c, misnamed(c, r)) for t, c, r in NUMBERED],
    ]


def tables_of(spark, d, questions, **given):
    """The tables that ``questions`` name; ``given`` ones instead of those in ``d``."""
    names = {t for a in questions for t in ([a.table] if isinstance(a, Count) else [a.of[0], *[t for t, _ in a.known]])}
    return {t: given[t] if t in given else load(spark, d, t) for t in sorted(names)}


_FACTS_SQL = "\nUNION ALL\n".join(
    [f"SELECT 'rows' AS kind, '{t}' AS subject, NULL AS \"column\", count(*) AS n FROM {t}" for t in COUNTED]
    + [f"SELECT 'nulls', '{t}', '{c}', CAST(count_if({c} IS NULL) AS BIGINT) FROM {t}" for t, cols in NULL_COLUMNS.items() if t != "ind" for c in cols]
    + [f"SELECT 'orphans', '{f}->{t}', '{fk}', count(*) FROM {f} WHERE {fk} IS NULL OR {fk} NOT IN (SELECT {k} FROM {t} WHERE {k} IS NOT NULL)"
       for f, fk, t, k in FK_PAIRS]
    + ["SELECT 'unused', 'nation', 'n_nationkey', count(DISTINCT n_nationkey) FROM nation WHERE n_nationkey NOT IN "
       "(SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL UNION SELECT c_nationkey FROM customer WHERE c_nationkey IS NOT NULL)",
       "SELECT 'negative', 'lineitem', 'l_quantity', CAST(count_if(l_quantity <= 0) AS BIGINT) FROM lineitem"]
    + [f"SELECT 'misnamed', '{t}', '{c}', CAST(count_if(NOT coalesce(regexp_matches({c}, '{r}'), FALSE)) AS BIGINT) FROM {t}" for t, c, r in NUMBERED])


@query("dq_scan_once", ids="C1 C3 C4 C7 C8 C9 J3 J4", sql=_FACTS_SQL + "\nORDER BY kind, subject, \"column\"")
def dq_scan_once(spark, d):
    """Row counts, NULLs, orphans, unused references and values out of bounds: each table is scanned once."""
    questions = asked({t: cols for t, cols in NULL_COLUMNS.items() if t != "ind"})
    return scan_once(tables_of(spark, d, questions), questions).orderBy("kind", "subject", "column")


def all_checks(spark, d):
    """Every check in one frame.

    Orders meet customer once, for the cells that IND and the recomputed
    truth share; ``scan_once`` reads each table once for whatever else is
    counted in it.  These frames are small at any scale and are checkpointed
    to the shared folder.
    """
    cells = materialize(order_cells(spark, d))
    ind = materialize(build_indicators_single_scan(spark, d, cells))
    sizes = materialize(customers_by_nation(spark, d))
    questions = asked()
    facts = materialize(scan_once(tables_of(spark, d, questions, ind=ind), questions))

    def fact(kind, subject=None):
        return facts.filter(F.col("kind") == kind) if subject is None else facts.filter((F.col("kind") == kind) & (F.col("subject") == subject))

    return Q.union_checks([
        row_count_checks(spark, d, fact("rows").select(F.col("subject").alias("table_name"), F.col("n").alias("actual_rows"))),
        first_region_check(spark, d),
        Q.count_rows(fact("rows", "region"), 5, "region count"),
        Q.count_rows(fact("rows", "nation"), 25, "nation count"),
        Q.orphan_rows(fact("orphans")),
        Q.null_rows(fact("nulls")),
        truth_compare_checks(spark, d, sizes),
        tolerance_rule_checks(spark, d, ind, cells),
        total_equal_checks(spark, d, ind, cells),
        sum_close_checks(spark, d, ind),
        Q.unused_rows(fact("unused"), "n_nationkey", "all nations referenced"),
        spot_checks(spark, d, ind, sizes, fact("negative")),
        naming_checks(spark, d, lambda t: fact("misnamed", t)),
    ])


def _all_checks_sql() -> str:
    return "all_checks AS (\n" + "\nUNION ALL\n".join(
        f"SELECT * FROM ({_BODIES[n]})" for n in _ALL) + "\n)"


@query("dq_summary", ids="C10 A22 A21", sql="WITH " + IND_SQL + ",\n" + _all_checks_sql() + """
SELECT coalesce(category, 'TOTAL') AS category, count(*) AS total,
       CAST(count_if(status = 'PASS') AS BIGINT) AS passed, CAST(count_if(status = 'FAIL') AS BIGINT) AS failed,
       CAST(count_if(status = 'MISSING') AS BIGINT) AS missing, CAST(count_if(status = 'SKIPPED') AS BIGINT) AS skipped,
       CAST(grouping(category) AS BOOLEAN) AS is_total
FROM all_checks GROUP BY ROLLUP (category) ORDER BY is_total, category
""")
def dq_summary(spark, d):
    return Q.summarize(all_checks(spark, d)).orderBy("is_total", "category")


@query("dq_tiers", ids="C10 A23", sql="WITH " + IND_SQL + ",\n" + _all_checks_sql() + f"""
SELECT CASE WHEN subject IN ({", ".join(_q(s) for s in VERIFIED_SUBJECTS)}) THEN 'verified'
            WHEN subject IS NOT NULL AND starts_with(category, '5-') THEN 'unverified'
            ELSE 'structural' END AS tier,
       status, count(*) AS checks
FROM all_checks GROUP BY 1, 2 ORDER BY 1, 2
""")
def dq_tiers(spark, d):
    return Q.confidence_tiers(all_checks(spark, d), VERIFIED_SUBJECTS).orderBy("tier", "status")
