"""Gap and freshness rules (G1-G12) on IND and the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from civicstat.functions.labels import clean_geography_name
from civicstat.operators import profile as P
from civicstat.plans.indicators import GAP_IND_SQL, customers, geography, gap_indicators, with_gap_ind, YEAR_SQL, sql_str
from civicstat.plans.profile_queries import SECTIONS, UNCOVERED_SQL, coverage_matrix
from civicstat.plans.registry import query
from civicstat.session import materialize
from civicstat.sources.tables import load

YEARS = tuple(range(1995, 2002))
_YEAR_SQL = YEAR_SQL
_SECTIONS_SQL = ", ".join(f"('{s}')" for s in SECTIONS)

# Expected characteristics per section (the gap report's "needed" lists).
EXPECTED_CHARACTERISTICS = (
    ("demand", "Orders"),
    ("demand", "Orders - 1-URGENT (number)"),
    ("demand", "Orders - 6-UNKNOWN (number)"),
    ("rates", "High value (rate)"),
    ("rates", "Open (rate)"),
    ("rates", "Returned (rate)"),
    ("segments", "Segment: GOVERNMENT"),
    ("shipments", "Shipments - A"),
    ("shipments", "Shipments - N"),
    ("shipments", "Shipments - R"),
    ("shipments", "Shipments - X"),
    ("activity", "Events - click"),
    ("activity", "Events - refund"),
)
DEPTH_SECTIONS = ("rates", "shipments")
GOOD_DEPTH = 7

# Issue register: rule -> issue type
RULES = {
    "G1 missing periods": "MISSING",
    "G2 missing characteristic": "MISSING",
    "G3 partial coverage": "INCOMPLETE",
    "G4 uneven depth": "INCOMPLETE",
    "G5 non-year period": "DATA QUALITY",
    "G6 name drift": "DATA QUALITY",
    "G8 low density": "INCOMPLETE",
    "G9 stale series": "STALE",
    "G10 available elsewhere": "INCOMPLETE",
    "G11 mostly out of scope": "INCOMPLETE",
}
LOW_DENSITY = 0.9
LOW_SCOPE_PCT = 50.0


_q = sql_str


_EXPECTED_CHARS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({_q(s)}, {_q(c)})" for s, c in EXPECTED_CHARACTERISTICS) + ") t(dashboard_section, characteristic)"

# ---- G1 ----------------------------------------------------------------

_PERIODS_BODY = f"""
SELECT g.dashboard_section, g.geography, g.year FROM (
  SELECT s.dashboard_section, n_name AS geography, CAST(y.year AS INTEGER) AS year
  FROM nation, (VALUES {_SECTIONS_SQL}) s(dashboard_section),
       (SELECT unnest(range({YEARS[0]}, {YEARS[-1] + 1})) AS year) y
  UNION ALL
  SELECT 'orders', c_name, CAST(y.year AS INTEGER) FROM customer, (SELECT unnest(range({YEARS[0]}, {YEARS[-1] + 1})) AS year) y
) g
WHERE NOT EXISTS (SELECT 1 FROM ind i WHERE i.dashboard_section = g.dashboard_section
                  AND i.geography = g.geography AND {_YEAR_SQL.replace('timeframe', 'i.timeframe')} = g.year)
"""


def missing_periods(ind, spark, d):
    return P.missing_periods(ind, geography(spark, d), SECTIONS, YEARS).unionByName(
        P.missing_periods(ind, customers(spark, d), ("orders",), YEARS))


@query("gap_periods", ids="G1", sql=with_gap_ind(_PERIODS_BODY + "ORDER BY 1, 2, 3"))
def gap_periods(spark, d):
    return missing_periods(gap_indicators(spark, d), spark, d).orderBy("dashboard_section", "geography", "year")


# ---- G2 ----------------------------------------------------------------

_CHARS_BODY = f"""
SELECT e.dashboard_section, e.characteristic FROM ({_EXPECTED_CHARS_SQL}) e
WHERE NOT EXISTS (SELECT 1 FROM ind i WHERE i.dashboard_section = e.dashboard_section
                  AND i.characteristic = e.characteristic)
"""


def missing_characteristics(spark, d):
    expected = spark.createDataFrame(list(EXPECTED_CHARACTERISTICS),
                                     "dashboard_section string, characteristic string").coalesce(1)
    return P.missing_characteristics(gap_indicators(spark, d), expected)


@query("gap_characteristics", ids="G2", sql=with_gap_ind(_CHARS_BODY + "ORDER BY 1, 2"))
def gap_characteristics(spark, d):
    return missing_characteristics(spark, d).orderBy("dashboard_section", "characteristic")


# ---- G4 ----------------------------------------------------------------

_DEPTH_BODY = f"""
WITH sec AS (SELECT * FROM ind WHERE dashboard_section IN ({", ".join(_q(s) for s in (*DEPTH_SECTIONS, "orders"))})),
chars AS (SELECT DISTINCT dashboard_section, characteristic FROM sec),
grid AS (SELECT c.dashboard_section, n_name AS geography, c.characteristic FROM chars c, nation WHERE c.dashboard_section <> 'orders'
         UNION ALL SELECT c.dashboard_section, c_name, c.characteristic FROM chars c, customer WHERE c.dashboard_section = 'orders'),
yrs AS (SELECT dashboard_section, geography, characteristic, count(DISTINCT timeframe) AS periods FROM sec
        WHERE {_YEAR_SQL} IS NOT NULL GROUP BY 1, 2, 3),
o AS (SELECT g.dashboard_section, g.geography, g.characteristic, coalesce(y.periods, 0) AS periods
      FROM grid g LEFT JOIN yrs y ON g.dashboard_section = y.dashboard_section AND g.geography = y.geography
      AND g.characteristic = y.characteristic)
SELECT dashboard_section, geography, characteristic, periods,
       CASE WHEN periods >= {GOOD_DEPTH} THEN 'good' WHEN periods >= 1 THEN 'sparse' ELSE 'missing' END AS depth
FROM o
"""


def depth(ind, spark, d):
    return P.depth(ind, geography(spark, d), DEPTH_SECTIONS, good=GOOD_DEPTH).unionByName(
        P.depth(ind, customers(spark, d), "orders", good=GOOD_DEPTH)).select(
        "dashboard_section", "geography", "characteristic", "periods", "depth")


@query("gap_depth", ids="G4", sql=with_gap_ind(_DEPTH_BODY + "ORDER BY 1, 2, 3"))
def gap_depth(spark, d):
    return depth(gap_indicators(spark, d), spark, d).orderBy("dashboard_section", "geography", "characteristic")


# ---- G5 ----------------------------------------------------------------

_BAD_BODY = f"""
SELECT dashboard_section, timeframe, count(*) AS rows FROM ind WHERE {_YEAR_SQL} IS NULL GROUP BY 1, 2
"""


@query("gap_bad_timeframe", ids="G5", sql=with_gap_ind(_BAD_BODY + "ORDER BY 1, 2"))
def gap_bad_timeframe(spark, d):
    return P.bad_periods(gap_indicators(spark, d)).orderBy("dashboard_section", "timeframe")


# ---- G6 / G7 -------------------------------------------------------------

# Display names as a second source shows them: the Middle East nations as
# 'Unknown', African nations with their region appended.
_SOURCE_NAMES_SQL = """
SELECT CAST(n_nationkey AS VARCHAR) AS geography_id,
       CASE WHEN r_name LIKE '%EAST%' THEN 'Unknown'
            WHEN r_name = 'AFRICA' THEN n_name || ' (' || r_name || ')'
            ELSE n_name END AS geography
FROM nation JOIN region ON n_regionkey = r_regionkey
"""

_DRIFT_BODY = f"""
WITH src AS (SELECT DISTINCT geography_id, geography AS source_name FROM ({_SOURCE_NAMES_SQL})),
dim AS (SELECT DISTINCT CAST(n_nationkey AS VARCHAR) AS geography_id, n_name AS dim_name FROM nation)
SELECT s.geography_id, s.source_name, d.dim_name,
       CASE WHEN d.dim_name IS NULL THEN 'unknown id' WHEN lower(s.source_name) = 'unknown' THEN 'unknown'
            WHEN starts_with(s.source_name, d.dim_name) THEN 'decorated' ELSE 'different' END AS drift,
       coalesce(d.dim_name, trim(regexp_replace(regexp_replace(regexp_replace(s.source_name, '\\s*\\(.*$', ''),
                ',.*$', ''), '\\s+', ' ', 'g'))) AS standard_name
FROM src s LEFT JOIN dim d ON s.geography_id = d.geography_id
WHERE d.dim_name IS NULL OR s.source_name <> d.dim_name
"""


def source_names(spark, d):
    nation = load(spark, d, "nation")
    region = load(spark, d, "region")
    j = nation.join(region, nation.n_regionkey == region.r_regionkey)
    name = (F.when(F.col("r_name").like("%EAST%"), F.lit("Unknown"))
            .when(F.col("r_name") == "AFRICA", F.concat(F.col("n_name"), F.lit(" ("), F.col("r_name"), F.lit(")")))
            .otherwise(F.col("n_name")))
    return j.select(F.col("n_nationkey").cast("string").alias("geography_id"), name.alias("geography"))


def drift(spark, d):
    dim = load(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("geography_id"),
                                          F.col("n_name").alias("geography"))
    return P.name_drift(source_names(spark, d), dim)


@query("gap_name_drift", ids="G6 G7", sql=_DRIFT_BODY + "ORDER BY geography_id")
def gap_name_drift(spark, d):
    return drift(spark, d).orderBy("geography_id")


@query("label_clean_names", ids="G7", sql=f"""
SELECT geography_id, geography AS source_name,
       trim(regexp_replace(regexp_replace(regexp_replace(geography, '\\s*\\(.*$', ''), ',.*$', ''), '\\s+', ' ', 'g'))
         AS cleaned_name
FROM ({_SOURCE_NAMES_SQL}) ORDER BY geography_id
""")
def label_clean_names(spark, d):
    """G7 text fallback on its own (used when no dimension row matches)."""
    s = source_names(spark, d)
    return s.select("geography_id", F.col("geography").alias("source_name"),
                    clean_geography_name("geography").alias("cleaned_name")).orderBy("geography_id")


# ---- G8 ----------------------------------------------------------------

_DENSITY_BODY = """
WITH g AS (SELECT dashboard_section, count(*) AS rows, count(DISTINCT geography) AS communities,
                  count(DISTINCT characteristic) AS characteristics, count(DISTINCT timeframe) AS timeframes
           FROM ind GROUP BY dashboard_section)
SELECT *, communities * characteristics * timeframes AS expected_cells,
       CAST(rows AS DOUBLE) / CAST(communities * characteristics * timeframes AS DOUBLE) AS density
FROM g
"""


@query("gap_density", ids="G8", sql=with_gap_ind(_DENSITY_BODY + "ORDER BY dashboard_section"))
def gap_density(spark, d):
    return P.density(gap_indicators(spark, d)).orderBy("dashboard_section")


# ---- G9 ----------------------------------------------------------------

_STALE_BODY = f"""
WITH last AS (SELECT dashboard_section, characteristic, geography, max({_YEAR_SQL}) AS last_year FROM ind
              WHERE {_YEAR_SQL} IS NOT NULL GROUP BY 1, 2, 3),
peer AS (SELECT dashboard_section, characteristic, max(last_year) AS peer_last_year FROM last GROUP BY 1, 2)
SELECT l.dashboard_section, l.characteristic, l.geography, l.last_year, p.peer_last_year,
       p.peer_last_year - l.last_year AS years_behind
FROM last l JOIN peer p ON l.dashboard_section = p.dashboard_section AND l.characteristic = p.characteristic
WHERE l.last_year < p.peer_last_year
"""


@query("gap_stale", ids="G9", sql=with_gap_ind(_STALE_BODY + "ORDER BY 1, 2, 3"))
def gap_stale(spark, d):
    return P.stale_series(gap_indicators(spark, d)).select(
        "dashboard_section", "characteristic", "geography", "last_year", "peer_last_year", "years_behind") \
        .orderBy("dashboard_section", "characteristic", "geography")


# ---- G10 ---------------------------------------------------------------

_ELSEWHERE_BODY = """
SELECT 'activity' AS missing_in, 'orders' AS found_in, geography FROM (
  SELECT DISTINCT geography FROM ind WHERE dashboard_section = 'orders'
  EXCEPT SELECT DISTINCT geography FROM ind WHERE dashboard_section = 'activity')
"""


@query("gap_elsewhere", ids="G10", sql=with_gap_ind(_ELSEWHERE_BODY + "ORDER BY geography"))
def gap_elsewhere(spark, d):
    return P.available_elsewhere(gap_indicators(spark, d), "activity", "orders").orderBy("geography")


# ---- G11 ---------------------------------------------------------------

_SCOPE_BODY = """
WITH lab AS (SELECT DISTINCT doc_id FROM labels),
t AS (SELECT source, count(*) AS total_rows, count(lab.doc_id) AS in_scope_rows
      FROM documents LEFT JOIN lab ON documents.doc_id = lab.doc_id GROUP BY source)
SELECT source, total_rows, in_scope_rows,
       CAST((2000 * in_scope_rows + total_rows) // (2 * total_rows) AS DOUBLE) / 10 AS in_scope_pct
FROM t
"""


def scope_share(spark, d):
    """Share of each document source that is labelled (in scope)."""
    docs = load(spark, d, "documents").select("doc_id", "source")
    lab = load(spark, d, "labels").select(F.col("doc_id").alias("__lab")).distinct()
    j = docs.join(lab, docs.doc_id == lab["__lab"], "left")
    return P.scope_share(j, "source", F.col("__lab").isNotNull())


@query("gap_scope_share", ids="G11", sql=_SCOPE_BODY + "ORDER BY source")
def gap_scope_share(spark, d):
    return scope_share(spark, d).orderBy("source")


# ---- G12 ---------------------------------------------------------------

def _issue_sql(rule: str, priority: str, section: str, subject: str, detail: str, body: str) -> str:
    return (f"SELECT {_q(rule)} AS rule, CAST({section} AS VARCHAR) AS section, CAST({subject} AS VARCHAR) AS subject, "
            f"{_q(RULES[rule])} AS issue_type, {priority} AS priority, CAST({detail} AS VARCHAR) AS detail FROM ({body})")


# A finding's priority: the newest expected year, a characteristic or a whole series that is absent weigh most.
_REGISTER_SQL = "WITH " + GAP_IND_SQL + "\n" + "\nUNION ALL\n".join([
    _issue_sql("G1 missing periods", f"CASE WHEN year = {YEARS[-1]} THEN 'High' ELSE 'Medium' END", "dashboard_section", "geography",
               "'year ' || CAST(year AS VARCHAR)", _PERIODS_BODY),
    _issue_sql("G2 missing characteristic", "'High'", "dashboard_section", "characteristic", "'not in data'", _CHARS_BODY),
    _issue_sql("G3 partial coverage", "CASE WHEN 2 * covered < total THEN 'High' ELSE 'Medium' END", "dashboard_section", "geography",
               "'covered ' || CAST(covered AS VARCHAR) || ' of ' || CAST(total AS VARCHAR)", UNCOVERED_SQL),
    _issue_sql("G4 uneven depth", "CASE WHEN depth = 'missing' THEN 'High' ELSE 'Medium' END", "dashboard_section",
               "geography || ' / ' || characteristic", "depth || ': ' || CAST(periods AS VARCHAR) || ' periods'",
               f"SELECT * FROM ({_DEPTH_BODY}) WHERE depth <> 'good'"),
    _issue_sql("G5 non-year period", "'High'", "dashboard_section", "timeframe", "CAST(rows AS VARCHAR) || ' rows'", _BAD_BODY),
    _issue_sql("G6 name drift", "CASE WHEN drift = 'decorated' THEN 'Low' ELSE 'Medium' END", "NULL", "geography_id",
               "drift || ': ' || source_name", _DRIFT_BODY),
    _issue_sql("G8 low density", "CASE WHEN 2 * rows < expected_cells THEN 'Medium' ELSE 'Low' END", "dashboard_section", "'all cells'",
               "CAST(rows AS VARCHAR) || ' of ' || CAST(expected_cells AS VARCHAR)",
               f"SELECT * FROM ({_DENSITY_BODY}) WHERE density < {LOW_DENSITY}"),
    _issue_sql("G9 stale series", "CASE WHEN years_behind >= 3 THEN 'High' WHEN years_behind = 2 THEN 'Medium' ELSE 'Low' END",
               "dashboard_section", "geography || ' / ' || characteristic",
               "'last ' || CAST(last_year AS VARCHAR) || ' vs ' || CAST(peer_last_year AS VARCHAR)", _STALE_BODY),
    _issue_sql("G10 available elsewhere", "'Medium'", "missing_in", "geography", "'found in ' || found_in", _ELSEWHERE_BODY),
    _issue_sql("G11 mostly out of scope", "CASE WHEN 10 * in_scope_rows < total_rows THEN 'High' ELSE 'Low' END", "'documents'", "source",
               "CAST(in_scope_rows AS VARCHAR) || ' of ' || CAST(total_rows AS VARCHAR)",
               f"SELECT * FROM ({_SCOPE_BODY}) WHERE in_scope_pct < {LOW_SCOPE_PCT}"),
]) + "\nORDER BY rule, section, subject"


def issue_register(spark, d):
    """Findings of all rules; IND and the series are built once."""
    ind = materialize(gap_indicators(spark, d))
    expected = spark.createDataFrame(list(EXPECTED_CHARACTERISTICS),
                                     "dashboard_section string, characteristic string").coalesce(1)
    c, text = F.col, lambda name: F.col(name).cast("string")

    def rule(name, priority, df, section, subject, detail):
        return P.issue(df, name, RULES[name], priority, section, subject, detail)

    series = F.concat("geography", F.lit(" / "), "characteristic")
    return P.issue_register([
        rule("G1 missing periods", F.when(c("year") == YEARS[-1], "High").otherwise("Medium"), missing_periods(ind, spark, d),
             "dashboard_section", c("geography"), F.concat(F.lit("year "), text("year"))),
        rule("G2 missing characteristic", "High", P.missing_characteristics(ind, expected), "dashboard_section",
             c("characteristic"), F.lit("not in data")),
        rule("G3 partial coverage", F.when(2 * c("covered") < c("total"), "High").otherwise("Medium"),
             P.uncovered(coverage_matrix(ind, spark, d)), "dashboard_section", c("geography"),
             F.concat(F.lit("covered "), text("covered"), F.lit(" of "), text("total"))),
        rule("G4 uneven depth", F.when(c("depth") == "missing", "High").otherwise("Medium"), depth(ind, spark, d).filter("depth <> 'good'"),
             "dashboard_section", series, F.concat("depth", F.lit(": "), text("periods"), F.lit(" periods"))),
        rule("G5 non-year period", "High", P.bad_periods(ind), "dashboard_section", c("timeframe"),
             F.concat(text("rows"), F.lit(" rows"))),
        rule("G6 name drift", F.when(c("drift") == "decorated", "Low").otherwise("Medium"), drift(spark, d), None,
             c("geography_id"), F.concat("drift", F.lit(": "), "source_name")),
        rule("G8 low density", F.when(2 * c("rows") < c("expected_cells"), "Medium").otherwise("Low"),
             P.density(ind).filter(c("density") < LOW_DENSITY), "dashboard_section", F.lit("all cells"),
             F.concat(text("rows"), F.lit(" of "), text("expected_cells"))),
        rule("G9 stale series", F.when(c("years_behind") >= 3, "High").when(c("years_behind") == 2, "Medium").otherwise("Low"),
             P.stale_series(ind), "dashboard_section", series,
             F.concat(F.lit("last "), text("last_year"), F.lit(" vs "), text("peer_last_year"))),
        rule("G10 available elsewhere", "Medium", P.available_elsewhere(ind, "activity", "orders"), "missing_in",
             c("geography"), F.concat(F.lit("found in "), "found_in")),
        rule("G11 mostly out of scope", F.when(10 * c("in_scope_rows") < c("total_rows"), "High").otherwise("Low"),
             scope_share(spark, d).filter(c("in_scope_pct") < LOW_SCOPE_PCT), F.lit("documents"), c("source"),
             F.concat(text("in_scope_rows"), F.lit(" of "), text("total_rows"))),
    ])


@query("gap_issue_register", ids="G12 G1 G2 G3 G4 G5 G6 G8 G9 G10 G11", sql=_REGISTER_SQL)
def gap_issue_register(spark, d):
    return issue_register(spark, d).orderBy("rule", "section", "subject")


@query("gap_issue_counts", ids="G12", sql="WITH reg AS (" + _REGISTER_SQL.replace("\nORDER BY rule, section, subject", "")
       + ")\nSELECT rule, issue_type, priority, count(*) AS findings FROM reg GROUP BY 1, 2, 3 ORDER BY 1, 3")
def gap_issue_counts(spark, d):
    return P.issue_counts(issue_register(spark, d)).orderBy("rule", "priority")
