"""Profiles (A3-A8, A21) and gap / freshness rules (G1-G12) of a long table.

All operators are grouped aggregations or joins against small expectation
relations.  Expected grids (section x geography x period) are generated
with ``explode`` over the geography dimension or an equi-join on the
section key, so their size is the product of dimension sizes and never
grows with the fact rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.functions.labels import clean_geography_name
from civicstat.functions.numeric import pct_half_up
from civicstat.operators.longform import (CHARACTERISTIC, GEOGRAPHY, GEOGRAPHY_ID, SECTION, TIMEFRAME,
                                          VALUE, parse_year)


def _distinct(col: str, approx: bool) -> Column:
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def section_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """A3: rows and distinct geographies / characteristics / periods per section."""
    return df.groupBy(SECTION).agg(
        F.count(F.lit(1)).alias("row_count"),
        _distinct(GEOGRAPHY, approx).alias("communities"),
        _distinct(CHARACTERISTIC, approx).alias("characteristics"),
        _distinct(TIMEFRAME, approx).alias("timeframes"))


def characteristic_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """A4: per (section, characteristic)."""
    return df.groupBy(SECTION, CHARACTERISTIC).agg(
        F.count(F.lit(1)).alias("row_count"),
        _distinct(GEOGRAPHY, approx).alias("communities"),
        _distinct(TIMEFRAME, approx).alias("timeframes"))


def _completeness_aggs(approx: bool) -> list[Column]:
    year = parse_year(TIMEFRAME)
    return [
        F.count(F.lit(1)).alias("total_rows"),
        _distinct(GEOGRAPHY, approx).alias("communities"),
        _distinct(CHARACTERISTIC, approx).alias("characteristics"),
        _distinct(TIMEFRAME, approx).alias("timeframes"),
        F.min(TIMEFRAME).alias("earliest_period"),      # lexicographic, as the reference
        F.max(TIMEFRAME).alias("latest_period"),
        F.min(year).alias("earliest_year"),              # parsed years: the right answer
        F.max(year).alias("latest_year"),
        F.count_if(F.col(VALUE).isNull()).alias("null_values"),
        F.count(VALUE).alias("__nn"),
    ]


def _finish_completeness(g: DataFrame) -> DataFrame:
    return (g.withColumn("pct_complete", pct_half_up(F.col("__nn"), F.col("total_rows"), 1))
            .drop("__nn"))


def completeness_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Full completeness profile per section."""
    return _finish_completeness(df.groupBy(SECTION).agg(*_completeness_aggs(approx)))


def completeness_rollup(df: DataFrame, approx: bool = False) -> DataFrame:
    """Completeness per section plus a grand-total row (section 'TOTAL')."""
    g = df.rollup(SECTION).agg(*_completeness_aggs(approx), F.grouping(SECTION).alias("__g"))
    g = g.withColumn(SECTION, F.when(F.col("__g") == 1, F.lit("TOTAL")).otherwise(F.col(SECTION))) \
         .withColumn("is_total", F.col("__g") == 1).drop("__g")
    return _finish_completeness(g)


# ------------------------------------------------------------------ gaps

def expected_period_grid(geo: DataFrame, sections: Sequence[str], years: Sequence[int]) -> DataFrame:
    """(section, geography, year) for every geography of the dimension."""
    return geo.select(GEOGRAPHY,
                      F.explode(F.array(*[F.lit(s) for s in sections])).alias(SECTION)) \
              .select(SECTION, GEOGRAPHY, F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("year"))


def missing_periods(df: DataFrame, geo: DataFrame, sections: Sequence[str], years: Sequence[int]) -> DataFrame:
    """G1: expected (section, geography, year) cells with no row at all."""
    observed = df.select(SECTION, GEOGRAPHY, parse_year(TIMEFRAME).alias("year")).distinct()
    grid = expected_period_grid(geo, sections, years)
    return grid.join(observed, [SECTION, GEOGRAPHY, "year"], "left_anti")


def missing_characteristics(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (section, characteristic) pairs absent from the data."""
    observed = df.select(SECTION, CHARACTERISTIC).distinct()
    return expected.join(observed, [SECTION, CHARACTERISTIC], "left_anti")


def coverage_matrix(df: DataFrame, geo: DataFrame, sections: Sequence[str]) -> DataFrame:
    """Rows per (section, geography) including zero cells."""
    counts = df.groupBy(SECTION, GEOGRAPHY).agg(F.count(F.lit(1)).alias("rows"))
    grid = geo.select(GEOGRAPHY, F.explode(F.array(*[F.lit(s) for s in sections])).alias(SECTION))
    return (grid.join(counts, [SECTION, GEOGRAPHY], "left")
            .withColumn("rows", F.coalesce(F.col("rows"), F.lit(0).cast("bigint"))))


def coverage_summary(matrix: DataFrame, names: bool = True) -> DataFrame:
    """Covered n of N geographies per section, and the names of those without a row.

    The names are one cell, at most one for each row of the geography
    dimension; for a large dimension leave them out and use ``uncovered``.
    """
    listed = F.array_join(F.sort_array(F.collect_list(F.when(F.col("rows") == 0, F.col(GEOGRAPHY)))), ", ")
    return matrix.groupBy(SECTION).agg(
        F.count_if(F.col("rows") > 0).alias("covered"), F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("rows") == 0).alias("uncovered"), *([listed.alias("missing")] if names else []))


def uncovered(matrix: DataFrame) -> DataFrame:
    """The geographies of a section without a row, one a row, with covered n of N."""
    n_of = matrix.groupBy(SECTION).agg(F.count_if(F.col("rows") > 0).alias("covered"), F.count(F.lit(1)).alias("total"))
    return matrix.filter("rows = 0").select(SECTION, GEOGRAPHY).join(n_of, SECTION)


def depth(df: DataFrame, geo: DataFrame, sections: str | Sequence[str], good: int, sparse: int = 1) -> DataFrame:
    """Distinct periods per (section, geography, characteristic) over the full grid.

    The grid is each section's characteristics joined to the geography
    dimension on the section key; depth >= ``good`` is 'good', >= ``sparse``
    'sparse', else 'missing'.
    """
    secs = [sections] if isinstance(sections, str) else list(sections)
    sec = df.filter(F.col(SECTION).isin(secs))
    chars = sec.select(SECTION, CHARACTERISTIC).distinct()
    geos = geo.select(GEOGRAPHY, F.explode(F.array(*[F.lit(s) for s in secs])).alias(SECTION))
    grid = geos.join(chars, SECTION)
    years = (sec.filter(parse_year(TIMEFRAME).isNotNull())
             .groupBy(SECTION, GEOGRAPHY, CHARACTERISTIC).agg(F.count_distinct(TIMEFRAME).alias("periods")))
    out = grid.join(years, [SECTION, GEOGRAPHY, CHARACTERISTIC], "left") \
              .withColumn("periods", F.coalesce(F.col("periods"), F.lit(0).cast("bigint")))
    return out.withColumn("depth", F.when(F.col("periods") >= good, F.lit("good"))
                          .when(F.col("periods") >= sparse, F.lit("sparse")).otherwise(F.lit("missing")))


def bad_periods(df: DataFrame) -> DataFrame:
    """Non-year period values with their row counts per section."""
    return (df.filter(parse_year(TIMEFRAME).isNull())
            .groupBy(SECTION, TIMEFRAME).agg(F.count(F.lit(1)).alias("rows")))


def name_drift(source: DataFrame, dim: DataFrame, id_col: str = GEOGRAPHY_ID,
               name_col: str = GEOGRAPHY, dim_name_col: str = GEOGRAPHY) -> DataFrame:
    """G6 + G7: names that differ from the dimension for the same id.

    Classifies 'unknown' (placeholder name), 'decorated' (dimension name
    plus appended text) and 'different'; ``standard_name`` takes the
    dimension name by id, else a cleaned-up display name.
    """
    names = source.select(F.col(id_col).alias("__id"), F.col(name_col).alias("source_name")).distinct()
    d = dim.select(F.col(id_col).alias("__id"), F.col(dim_name_col).alias("dim_name")).distinct()
    j = names.join(d, "__id", "left")
    kind = (F.when(F.col("dim_name").isNull(), F.lit("unknown id"))
            .when(F.col("source_name").isNull() | (F.lower(F.col("source_name")) == "unknown"), F.lit("unknown"))
            .when(F.col("source_name").startswith(F.col("dim_name")), F.lit("decorated"))
            .otherwise(F.lit("different")))
    return (j.filter(F.col("dim_name").isNull() | ~F.col("source_name").eqNullSafe(F.col("dim_name")))
            .select(F.col("__id").alias(id_col), "source_name", "dim_name", kind.alias("drift"),
                    F.coalesce(F.col("dim_name"), clean_geography_name(F.col("source_name"))).alias("standard_name")))


def density(df: DataFrame, by: str = SECTION) -> DataFrame:
    """Rows vs the product of distinct geographies, characteristics, periods."""
    g = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(GEOGRAPHY).alias("communities"),
        F.count_distinct(CHARACTERISTIC).alias("characteristics"),
        F.count_distinct(TIMEFRAME).alias("timeframes"))
    cells = F.col("communities") * F.col("characteristics") * F.col("timeframes")
    return (g.withColumn("expected_cells", cells)
            .withColumn("density", F.col("rows").cast("double") / F.col("expected_cells").cast("double")))


def stale_series(df: DataFrame, keys: Sequence[str] = (SECTION, CHARACTERISTIC)) -> DataFrame:
    """Groups whose last year lags the newest year of their peers."""
    k = list(keys)
    last = (df.filter(parse_year(TIMEFRAME).isNotNull())
            .groupBy(*k, GEOGRAPHY).agg(F.max(parse_year(TIMEFRAME)).alias("last_year")))
    peer = last.groupBy(*k).agg(F.max("last_year").alias("peer_last_year"))
    return (last.join(peer, k).filter(F.col("last_year") < F.col("peer_last_year"))
            .withColumn("years_behind", F.col("peer_last_year") - F.col("last_year")))


def available_elsewhere(df: DataFrame, target_section: str, other_section: str,
                        key: str = GEOGRAPHY) -> DataFrame:
    """Keys absent from one section but present in another."""
    target = df.filter(F.col(SECTION) == target_section).select(key).distinct()
    other = df.filter(F.col(SECTION) == other_section).select(key).distinct()
    return (other.join(target, key, "left_anti")
            .select(F.lit(target_section).alias("missing_in"), F.lit(other_section).alias("found_in"), key))


def scope_share(df: DataFrame, group: str, in_scope: Column) -> DataFrame:
    """Rows in scope out of all rows per group, with percent."""
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("total_rows"),
                              F.count_if(in_scope).alias("in_scope_rows"))
    return g.withColumn("in_scope_pct", pct_half_up(F.col("in_scope_rows"), F.col("total_rows"), 1))


ISSUE_COLUMNS = ("rule", "section", "subject", "issue_type", "priority", "detail")


def issue(df: DataFrame, rule: str, issue_type: str, priority: Column | str, section: Column | str | None,
          subject: Column, detail: Column) -> DataFrame:
    """One issue-register row per finding of a gap rule; ``priority`` is one for the rule, or a column for each finding."""
    prio = F.lit(priority) if isinstance(priority, str) else priority
    sec = F.col(section) if isinstance(section, str) else (section if section is not None else F.lit(None))
    return df.select(F.lit(rule).alias("rule"), sec.cast("string").alias("section"),
                     subject.cast("string").alias("subject"), F.lit(issue_type).alias("issue_type"),
                     prio.alias("priority"), detail.cast("string").alias("detail"))


def issue_register(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of rule findings in the issue schema."""
    out = parts[0].select(*ISSUE_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*ISSUE_COLUMNS))
    return out


def issue_counts(register: DataFrame) -> DataFrame:
    """G12 summary: findings per rule, type and priority."""
    return register.groupBy("rule", "issue_type", "priority").agg(F.count(F.lit(1)).alias("findings"))
