"""Data-quality checks (C1-C10) producing one ``checks`` frame.

    checks(category, check_name, subject, column, status, actual, expected, diff, detail)
    status in PASS, FAIL, MISSING, SKIPPED

Every check is driven from the expectation side: an expected table, key or
subject with no actual counterpart yields MISSING (the reference silently
records nothing in that case, so it can pass vacuously).  Each check is a
Spark aggregation or join over the data; only the (small) check rows are
ever collected, by the caller.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicstat.functions.numeric import as_double, tolerance_pass, truncate, DEFAULT_TOLERANCE
from civicstat.operators.scan import Lookup, scan_once

CHECK_COLUMNS = ("category", "check_name", "subject", "column", "status",
                 "actual", "expected", "diff", "detail")

CHECK_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("subject", T.StringType(), True),
    T.StructField("column", T.StringType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("actual", T.DoubleType(), True),
    T.StructField("expected", T.DoubleType(), True),
    T.StructField("diff", T.DoubleType(), True),
    T.StructField("detail", T.StringType(), True),
])

PASS, FAIL, MISSING, SKIPPED = "PASS", "FAIL", "MISSING", "SKIPPED"


def _lit(v, t="string") -> Column:
    return F.lit(v).cast(t)


def check_row(category, check_name, subject=None, column=None, status=None,
              actual=None, expected=None, diff=None, detail=None) -> list[Column]:
    """Column list in CHECK_COLUMNS order; plain values become literals."""
    def c(v, t):
        return v.cast(t) if isinstance(v, Column) else _lit(v, t)
    return [c(category, "string").alias("category"), c(check_name, "string").alias("check_name"),
            c(subject, "string").alias("subject"), c(column, "string").alias("column"),
            c(status, "string").alias("status"), c(actual, "double").alias("actual"),
            c(expected, "double").alias("expected"), c(diff, "double").alias("diff"),
            c(detail, "string").alias("detail")]


def union_checks(parts: Iterable[DataFrame]) -> DataFrame:
    parts = [p.select(*CHECK_COLUMNS) for p in parts]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL))


def _count_text(label: str, v: Column) -> Column:
    return F.concat(F.lit(label + "="), v.cast("bigint").cast("string"))


# -- C1 -------------------------------------------------------------------

def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, actual_rows): one count per table in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("actual_rows")).select(
        F.lit(name).alias("table_name"), "actual_rows") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def row_count_checks(actual: DataFrame, expected: DataFrame, category: str = "1-rowcounts") -> DataFrame:
    """Exact row counts; an expected table without a count is MISSING.

    ``actual(table_name, actual_rows)``, ``expected(table_name, expected_rows)``.
    """
    j = expected.join(actual, "table_name", "left")
    a, e = F.col("actual_rows"), F.col("expected_rows")
    status = F.when(a.isNull(), F.lit(MISSING)).otherwise(_status(a == e))
    detail = F.when(a.isNull(), F.lit("table not found")).when(
        a != e, F.concat(_count_text("actual", a), F.lit(" "), _count_text("expected", e)))
    return j.select(*check_row(category, F.col("table_name"), None, None, status, a, e,
                               F.abs(a - e), detail))


# -- C2 -------------------------------------------------------------------

def key_set_check(actual: DataFrame, expected: DataFrame, key: str, name: str,
                  category: str = "2-dims") -> DataFrame:
    """Key-set equality as one check row (counts of missing / extra)."""
    a = actual.select(F.col(key).alias("__a"), F.lit(True).alias("__in_a")).distinct()
    e = expected.select(F.col(key).alias("__e"), F.lit(True).alias("__in_e")).distinct()
    # flags tell presence, so that a NULL key is a key like any other
    j = e.join(a, e["__e"].eqNullSafe(a["__a"]), "full_outer").agg(
        F.count("__in_a").alias("n_actual"), F.count("__in_e").alias("n_expected"),
        F.count_if(F.col("__in_a").isNull()).alias("n_missing"),
        F.count_if(F.col("__in_e").isNull()).alias("n_extra"))
    ok = (F.col("n_missing") == 0) & (F.col("n_extra") == 0)
    detail = F.when(~ok, F.concat(_count_text("missing", F.col("n_missing")), F.lit(" "),
                                  _count_text("extra", F.col("n_extra"))))
    return j.select(*check_row(category, name, None, key, _status(ok), F.col("n_actual"),
                               F.col("n_expected"), F.col("n_missing") + F.col("n_extra"), detail))


def count_check(df: DataFrame, expected: int, name: str, category: str = "2-dims") -> DataFrame:
    """A frame must hold exactly ``expected`` rows."""
    return count_rows(df.agg(F.count(F.lit(1)).alias("n")), expected, name, category)


def count_rows(facts: DataFrame, expected: int, name: str, category: str = "2-dims") -> DataFrame:
    """``count_check`` from a count: ``facts(n)``."""
    ok = F.col("n") == expected
    return facts.select(*check_row(category, name, None, None, _status(ok), F.col("n"), expected,
                               F.abs(F.col("n") - F.lit(expected)),
                               F.when(~ok, _count_text("actual", F.col("n")))))


# -- C3 -------------------------------------------------------------------

def orphan_checks(pairs: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]],
                  category: str = "3-fk") -> DataFrame:
    """Orphan count per (fact, fk) -> (dim, key); 0 expected.

    ``pairs`` items: (fact_name, fact, fact_key, dim_name, dim, dim_key).
    """
    parts = []
    for fname, fact, fkey, dname, dim, dkey in pairs:
        keys = dim.select(F.col(dkey).alias("__k")).distinct()
        # rows by key first: a hot key sends one row a task into the join
        counts = fact.groupBy(F.col(fkey).alias("__f")).agg(F.count(F.lit(1)).alias("__n"))
        n = counts.join(keys, F.col("__f") == F.col("__k"), "left_anti") \
                  .agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))
        parts.append(n.select(*check_row(
            category, f"{fname}->{dname}", fname, fkey, _status(F.col("n") == 0), F.col("n"), 0,
            F.col("n"), F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" orphan rows"))))))
    return union_checks(parts)


def orphan_rows(facts: DataFrame, category: str = "3-fk") -> DataFrame:
    """C3 from ``scan_once``: ``subject`` is 'fact->dim', ``column`` the fact's key."""
    n = F.col("n")
    return facts.select(*check_row(
        category, F.col("subject"), F.substring_index("subject", "->", 1), F.col("column"), _status(n == 0), n, 0, n,
        F.when(n > 0, F.concat(n.cast("string"), F.lit(" orphan rows")))))


def orphan_checks_one_scan(pairs: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]],
                           category: str = "3-fk") -> DataFrame:
    """``orphan_checks`` of many pairs, with one scan for each table; a name is one table."""
    tables = {name: df for fname, fact, _, dname, dim, _ in pairs for name, df in ((fname, fact), (dname, dim))}
    return orphan_rows(scan_once(tables, [Lookup("orphans", f"{f}->{d}", (f, fk), [(d, dk)]) for f, _, fk, d, _, dk in pairs]), category)


# -- C4 -------------------------------------------------------------------

def null_checks(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], category: str = "4-nulls") -> DataFrame:
    """NULL count per column, one aggregate pass per table.

    ``count_if`` gives 0 on an empty table (the SUM(CASE...) form gives NULL).
    """
    parts = []
    for name, (df, cols) in tables.items():
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        long = agg.unpivot([], list(cols), "column", "n")
        parts.append(null_rows(long.withColumn("subject", F.lit(name)), category))
    return union_checks(parts)


def null_rows(facts: DataFrame, category: str = "4-nulls") -> DataFrame:
    """C4 from counts of NULLs: ``facts(subject, column, n)``."""
    n = F.col("n")
    return facts.select(*check_row(
        category, F.concat(F.col("subject"), F.lit("."), F.col("column")), F.col("subject"), F.col("column"),
        _status(n == 0), n, 0, n, F.when(n > 0, F.concat(n.cast("string"), F.lit(" NULLs")))))


# -- C5 -------------------------------------------------------------------

def truth_checks(actual: DataFrame, truth: DataFrame, subject: str, measures: Sequence[str],
                 category: str, period: str | None = None,
                 tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """Compare actual measures against an expected relation.

    ``actual`` is wide (one row per subject [and period]).  It is unpivoted
    to (subject, period, column, actual) and the truth frame
    ``(subject, period, column, expected, is_fractional)`` is LEFT joined to
    it: an expected subject/period without any actual row is MISSING, a row
    whose value is NULL or non-numeric is FAIL (as in the reference).
    """
    ids = [F.col(subject).cast("string").alias("subject"),
           (F.col(period).cast("string") if period else F.lit("")).alias("period")]
    wide = actual.select(*ids, *[as_double(actual, m).alias(m) for m in measures])
    long = wide.unpivot(["subject", "period"], list(measures), "column", "actual")
    seen = wide.select("subject", "period", F.lit(True).alias("__seen")).distinct()
    t = truth.withColumn("period", F.coalesce(F.col("period"), F.lit("")))
    j = (t.join(long, ["subject", "period", "column"], "left")
         .join(seen, ["subject", "period"], "left"))
    a, e = F.col("actual"), F.col("expected")
    ok = tolerance_pass(a, e, F.col("is_fractional"), tolerance)
    status = (F.when(F.col("__seen").isNull(), F.lit(MISSING))
              .when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)))
    name = F.when(F.col("period") == "", F.concat_ws(".", "subject", "column")) \
            .otherwise(F.concat_ws(".", "subject", "period", "column"))
    detail = (F.when(F.col("__seen").isNull(), F.lit("no actual row"))
              .when(a.isNull(), F.lit("actual=NULL")))
    return j.select(*check_row(category, name, F.col("subject"), F.col("column"), status,
                               a, e, F.abs(a - e), detail))


# -- C6 -------------------------------------------------------------------

def equal_totals_check(left: DataFrame, right: DataFrame, key: str, name: str,
                       category: str = "6-consistency") -> DataFrame:
    """Per key, truncated left value equals truncated right value.

    ``left(key, value)``, ``right(key, value)``; a key on one side only is MISSING.
    """
    lft = left.select(F.col(key).cast("string").alias("subject"), F.col("value").alias("l"))
    rgt = right.select(F.col(key).cast("string").alias("subject"), F.col("value").alias("r"))
    j = lft.join(rgt, "subject", "full_outer")
    l, r = F.col("l"), F.col("r")
    status = F.when(l.isNull() | r.isNull(), F.lit(MISSING)).otherwise(_status(truncate(l) == truncate(r)))
    return j.select(*check_row(category, F.concat(F.col("subject"), F.lit(": " + name)), F.col("subject"),
                               None, status, l, r, F.abs(truncate(l) - truncate(r)), None))


def sum_close_check(parts: DataFrame, whole: DataFrame, key: str | Sequence[str], name: str, bound: float = 10,
                    category: str = "6-consistency") -> DataFrame:
    """Sum of parts per key within ``bound`` of the whole; NULL is a key like any other."""
    keys = [key] if isinstance(key, str) else list(key)
    p = parts.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.sum("value").alias("p"))
    subject = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    w = whole.select(*keys, subject.alias("subject"), F.col("value").alias("w"))
    j = w.join(p, reduce(lambda x, y: x & y, [w[k].eqNullSafe(p[f"__{k}"]) for k in keys]), "left")
    pv, wv = F.col("p"), F.col("w")
    diff = F.abs(truncate(pv) - truncate(wv))
    status = F.when(pv.isNull() | wv.isNull(), F.lit(MISSING)).otherwise(_status(diff <= F.lit(bound)))
    return j.select(*check_row(category, F.concat(F.col("subject"), F.lit(": " + name)), F.col("subject"),
                               None, status, pv, wv, diff,
                               F.when(diff > F.lit(bound), _count_text("diff", diff))))


# -- C7 -------------------------------------------------------------------

def unused_refs_check(dim: DataFrame, refs: Sequence[DataFrame], key: str, name: str,
                      category: str = "7-traceability") -> DataFrame:
    """Every dimension row referenced by at least one fact."""
    r = reduce(lambda a, b: a.unionByName(b),
               [x.select(F.col(key).alias("__r")) for x in refs]).distinct()
    d = dim.select(F.col(key).alias("__d")).distinct()
    agg = d.join(r, d["__d"] == r["__r"], "left").agg(
        F.count_if(F.col("__r").isNull()).alias("n"))
    return unused_rows(agg, key, name, category)


def unused_rows(facts: DataFrame, key: str, name: str, category: str = "7-traceability") -> DataFrame:
    """``unused_refs_check`` from the number of keys without a reference: ``facts(n)``."""
    n = F.col("n")
    return facts.select(*check_row(category, name, None, key, _status(n == 0), n, 0, n,
                                   F.when(n != 0, _count_text("unused", n))))


# -- C8 -------------------------------------------------------------------

def expect_rows(df: DataFrame, name: str, minimum: int | None = None, maximum: int | None = None,
                category: str = "8-spot") -> DataFrame:
    """A filtered frame must hold between ``minimum`` and ``maximum`` rows.

    Use maximum=0 for "violations must be empty", minimum=1 for "present".
    """
    return bound_rows(df.agg(F.count(F.lit(1)).alias("n")), name, minimum, maximum, category)


def bound_rows(facts: DataFrame, name: str, minimum: int | None = None, maximum: int | None = None,
               category: str = "8-spot") -> DataFrame:
    """``expect_rows`` from a count: ``facts(n)``."""
    n = F.col("n")
    ok = F.lit(True)
    if minimum is not None:
        ok = ok & (n >= minimum)
    if maximum is not None:
        ok = ok & (n <= maximum)
    exp = maximum if maximum is not None else minimum
    return facts.select(*check_row(category, name, None, None, _status(ok), n, exp, None,
                               F.when(~ok, _count_text("rows", n))))


# -- C9 -------------------------------------------------------------------

def naming_checks(names: DataFrame, pattern: str, name_col: str = "table_name",
                  category: str = "9-standards") -> DataFrame:
    """Each object name must match a naming pattern (rlike)."""
    ok = F.col(name_col).rlike(pattern)
    return names.select(*check_row(category, F.concat(F.lit("naming: "), F.col(name_col)),
                                   F.col(name_col), None, _status(ok), None, None, None,
                                   F.when(~ok, F.lit("pattern " + pattern))))


def described_checks(names: DataFrame, name_col: str = "table_name", desc_col: str = "description",
                     category: str = "9-standards") -> DataFrame:
    """Every object carries a comment/description."""
    ok = F.col(desc_col).isNotNull() & (F.length(F.trim(F.col(desc_col))) > 0)
    return names.select(*check_row(category, F.concat(F.lit("comment: "), F.col(name_col)),
                                   F.col(name_col), None, _status(ok), None, None, None, None))


# -- C10 ------------------------------------------------------------------

def summarize(checks: DataFrame) -> DataFrame:
    """Totals per category plus a grand-total row (category NULL)."""
    g = checks.rollup("category").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
        F.count_if(F.col("status") == MISSING).alias("missing"),
        F.count_if(F.col("status") == SKIPPED).alias("skipped"),
        F.grouping("category").alias("is_total"))
    return g.select(F.coalesce(F.col("category"), F.lit("TOTAL")).alias("category"),
                    "total", "passed", "failed", "missing", "skipped",
                    F.col("is_total").cast("boolean").alias("is_total"))


def confidence_tiers(checks: DataFrame, verified: Sequence[str]) -> DataFrame:
    """pass/fail counts in three disjoint tiers: verified, other, structural."""
    tier = (F.when(F.col("subject").isin(list(verified)), F.lit("verified"))
            .when(F.col("subject").isNotNull() & F.col("category").startswith("5-"), F.lit("unverified"))
            .otherwise(F.lit("structural")))
    return checks.groupBy(tier.alias("tier"), "status").agg(F.count(F.lit(1)).alias("checks"))


def skipped(spark: SparkSession, category: str, names: Iterable[str], reason: str) -> DataFrame:
    """Explicit SKIPPED rows for checks whose inputs do not exist."""
    rows = [(category, n, None, None, SKIPPED, None, None, None, reason) for n in names]
    return spark.createDataFrame(rows, CHECK_SCHEMA).coalesce(1)


# -- one-pass checks while writing ----------------------------------------

def write_with_checks(df: DataFrame, path: str, name: str, null_columns: Sequence[str] = (),
                      expected_rows: int | None = None, mode: str = "overwrite",
                      partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet and return row-count / NULL checks of what was written.

    The metrics are gathered by ``DataFrame.observe`` during the write
    itself, so validating a freshly built fact table costs no second scan.
    Observed metrics can be inflated when a stage is recomputed after an
    executor is lost, so a failing result is confirmed by recounting the
    written files (one scan, only on that path): a reported FAIL is exact.
    """
    from pyspark.sql import Observation
    obs = Observation(f"checks_{name}")
    metrics = [F.count(F.lit(1)).alias("__rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"__null_{i}") for i, c in enumerate(null_columns)]
    writer = df.observe(obs, *metrics).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    got = obs.get
    spark = df.sparkSession
    bad_rows = expected_rows is not None and int(got["__rows"]) != expected_rows
    if bad_rows or any(int(got[f"__null_{i}"]) for i in range(len(null_columns))):
        written = spark.read.parquet(path)
        got = written.agg(*metrics).first().asDict()
    rows = []
    n = int(got["__rows"])
    if expected_rows is not None:
        ok = n == expected_rows
        rows.append(("1-rowcounts", name, None, None, PASS if ok else FAIL, float(n), float(expected_rows),
                     float(abs(n - expected_rows)), None if ok else f"actual={n} expected={expected_rows}"))
    for i, c in enumerate(null_columns):
        k = int(got[f"__null_{i}"])
        rows.append(("4-nulls", f"{name}.{c}", name, c, PASS if k == 0 else FAIL, float(k), 0.0, float(k),
                     None if k == 0 else f"{k} NULLs"))
    return spark.createDataFrame(rows, CHECK_SCHEMA).coalesce(1)
