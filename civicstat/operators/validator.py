"""Spec-driven validation of a star schema (categories C1-C10 end to end).

``validate(spark, spec, database)`` resolves each table of the spec in the
catalog and returns one ``checks`` frame.  Unlike a validator that loops
over the tables that happen to exist, every expectation yields a row: a
missing table gives MISSING (row counts) or SKIPPED (checks that need it),
so a schema that was dropped cannot pass with zero checks.

All checks are Spark jobs over the tables; the spec itself is plain data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicstat.operators import quality as Q
from civicstat.sources.catalog import list_tables
from civicstat.sources.expected import expected_counts, truth_frame


@dataclass(frozen=True)
class TruthSpec:
    """Compare measures of one fact (joined to the geography dimension)."""
    category: str
    table: str
    measures: Sequence[str]
    truth: Mapping            # subject -> column -> value, or subject -> period -> column -> value
    period: str | None = None
    subjects: Sequence[str] | None = None     # restrict the compared subjects


@dataclass(frozen=True)
class TotalEqualSpec:
    """A filtered measure of one fact equals a measure of another, per subject."""
    name: str
    left_table: str
    left_measure: str
    right_table: str
    right_measure: str
    left_filter: str | None = None            # SQL predicate, e.g. "priority_group = 'community_total'"


@dataclass(frozen=True)
class SumCloseSpec:
    """The parts of one fact sum to within ``bound`` of a whole in another."""
    name: str
    parts_table: str
    parts_measure: str
    whole_table: str
    whole_measure: str
    bound: float = 10


@dataclass(frozen=True)
class SpotSpec:
    """A filtered row set must hold between ``minimum`` and ``maximum`` rows."""
    name: str
    table: str
    predicate: str                            # SQL predicate over fact + geography columns
    minimum: int | None = None
    maximum: int | None = None


@dataclass(frozen=True)
class StarSchemaSpec:
    expected_rows: Mapping[str, int]
    geo_facts: Sequence[str]
    timeframe_facts: Sequence[str] = ()
    geo_dim: str = "geography_dim"
    geo_key: str = "geography_key"
    geo_id: str = "geography_id"
    expected_geo_keys: Sequence[str] = ()
    timeframe_dim: str = "timeframe_dim"
    timeframe_id: str = "timeframe_id"
    census_flag: str = "is_census_year"
    expected_census_years: Sequence[int] = ()
    source_dim: str = "source_dim"
    source_id: str = "source_id"
    expected_sources: int | None = None
    null_columns: Sequence[str] = ("geography_id", "source_id")
    truths: Sequence[TruthSpec] = ()
    total_equal: Sequence[TotalEqualSpec] = ()
    sum_close: Sequence[SumCloseSpec] = ()
    spots: Sequence[SpotSpec] = ()
    name_pattern: str = r"^[a-z]+(_[a-z0-9]+)*$"
    expected_objects: int | None = None
    verified: Sequence[str] = field(default_factory=tuple)


def _resolver(spark: SparkSession, database: str | None):
    def name(t: str) -> str:
        return f"{database}.{t}" if database else t

    def exists(t: str) -> bool:
        return spark.catalog.tableExists(name(t))

    def table(t: str) -> DataFrame:
        return spark.table(name(t))
    return exists, table


def validate(spark: SparkSession, spec: StarSchemaSpec, database: str | None = None) -> DataFrame:
    exists, table = _resolver(spark, database)
    parts: list[DataFrame] = []
    skips: list[tuple] = []

    def skip(category: str, check: str, reason: str) -> None:
        skips.append((category, check, None, None, Q.SKIPPED, None, None, None, reason))

    # C1 row counts: expected tables without a table are MISSING
    present = {t: table(t) for t in spec.expected_rows if exists(t)}
    if present:
        actual = Q.table_counts(present)
    else:
        actual = spark.createDataFrame([], "table_name string, actual_rows bigint")
    parts.append(Q.row_count_checks(actual, expected_counts(spark, spec.expected_rows)))

    # C2 dimension integrity
    if spec.expected_geo_keys:
        if exists(spec.geo_dim):
            exp = spark.createDataFrame([(k,) for k in spec.expected_geo_keys], f"{spec.geo_key} string")
            parts.append(Q.key_set_check(table(spec.geo_dim), exp, spec.geo_key, f"{spec.geo_dim} completeness"))
        else:
            skip("2-dims", f"{spec.geo_dim} completeness", f"{spec.geo_dim} not found")
    if spec.expected_census_years:
        if exists(spec.timeframe_dim):
            tf = table(spec.timeframe_dim).filter(F.col(spec.census_flag)).select(
                F.col(spec.timeframe_id).cast("int").alias("y"))
            exp = spark.createDataFrame([(int(y),) for y in spec.expected_census_years], "y int")
            parts.append(Q.key_set_check(tf, exp, "y", "census years"))
        else:
            skip("2-dims", "census years", f"{spec.timeframe_dim} not found")
    if spec.expected_sources is not None:
        if exists(spec.source_dim):
            parts.append(Q.count_check(table(spec.source_dim), spec.expected_sources, f"{spec.source_dim} count"))
        else:
            skip("2-dims", f"{spec.source_dim} count", f"{spec.source_dim} not found")

    # C3 referential integrity (anti joins), C4 nulls (one pass per table)
    pairs = []
    for t in spec.geo_facts:
        if not exists(t):
            skip("3-fk", f"{t}->{spec.geo_dim}", f"{t} not found")
        elif not exists(spec.geo_dim):
            skip("3-fk", f"{t}->{spec.geo_dim}", f"{spec.geo_dim} not found")
        else:
            pairs.append((t, table(t), spec.geo_id, spec.geo_dim, table(spec.geo_dim), spec.geo_id))
    for t in spec.timeframe_facts:
        if not exists(t) or not exists(spec.timeframe_dim):
            skip("3-fk", f"{t}->{spec.timeframe_dim}", "table not found")
        else:
            pairs.append((t, table(t), spec.timeframe_id, spec.timeframe_dim, table(spec.timeframe_dim),
                          spec.timeframe_id))
    if pairs:
        parts.append(Q.orphan_checks(pairs))
    nulls = {t: (table(t), list(spec.null_columns)) for t in spec.geo_facts if exists(t)}
    for t in spec.geo_facts:
        if not exists(t):
            for c in spec.null_columns:
                skip("4-nulls", f"{t}.{c}", f"{t} not found")
    if nulls:
        parts.append(Q.null_checks(nulls))

    geo = table(spec.geo_dim).select(spec.geo_id, spec.geo_key) if exists(spec.geo_dim) else None

    # C5 truth cross-reference
    for ts in spec.truths:
        if geo is None or not exists(ts.table):
            skip(ts.category, ts.table, "table not found")
            continue
        fact = table(ts.table).join(geo, spec.geo_id)
        if ts.subjects is not None:
            fact = fact.filter(F.col(spec.geo_key).isin(list(ts.subjects)))
        truth = truth_frame(spark, ts.truth, nested_period=ts.period is not None)
        parts.append(Q.truth_checks(fact, truth, spec.geo_key, ts.measures, ts.category, period=ts.period))

    # C6 internal consistency
    for te in spec.total_equal:
        if geo is None or not (exists(te.left_table) and exists(te.right_table)):
            skip("6-consistency", te.name, "table not found")
            continue
        left = table(te.left_table)
        if te.left_filter:
            left = left.filter(F.expr(te.left_filter))
        lft = left.join(geo, spec.geo_id).select(spec.geo_key, F.col(te.left_measure).cast("double").alias("value"))
        rgt = table(te.right_table).join(geo, spec.geo_id).select(
            spec.geo_key, F.col(te.right_measure).cast("double").alias("value"))
        parts.append(Q.equal_totals_check(lft, rgt, spec.geo_key, te.name))
    for sc in spec.sum_close:
        if geo is None or not (exists(sc.parts_table) and exists(sc.whole_table)):
            skip("6-consistency", sc.name, "table not found")
            continue
        p = table(sc.parts_table).join(geo, spec.geo_id).select(
            spec.geo_key, F.col(sc.parts_measure).cast("double").alias("value"))
        w = table(sc.whole_table).join(geo, spec.geo_id).select(
            spec.geo_key, F.col(sc.whole_measure).cast("double").alias("value"))
        parts.append(Q.sum_close_check(p, w, spec.geo_key, sc.name, sc.bound))

    # C7 source traceability
    if exists(spec.source_dim):
        refs = [table(t).select(spec.source_id) for t in spec.geo_facts if exists(t)]
        if refs:
            parts.append(Q.unused_refs_check(table(spec.source_dim), refs, spec.source_id, "all sources referenced"))
        else:
            skip("7-traceability", "all sources referenced", "no fact table found")

    # C8 spot checks, recorded (the reference only printed them)
    for sp in spec.spots:
        if geo is None or not exists(sp.table):
            skip("8-spot", sp.name, "table not found")
            continue
        rows = table(sp.table).join(geo, spec.geo_id).filter(F.expr(sp.predicate))
        parts.append(Q.expect_rows(rows, sp.name, sp.minimum, sp.maximum))

    # C9 standards: naming pattern and number of objects in the schema
    names = list_tables(spark, database).filter(~F.col("is_temporary")) if database else None
    if names is not None:
        parts.append(Q.naming_checks(names, spec.name_pattern))
        if spec.expected_objects is not None:
            parts.append(Q.count_check(names, spec.expected_objects, "object count", category="9-standards"))
    if skips:   # all SKIPPED rows as one single-partition frame
        parts.append(spark.createDataFrame(skips, Q.CHECK_SCHEMA).coalesce(1))
    return Q.union_checks(parts)


def report(checks: DataFrame, verified: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary by category with total, confidence tiers, failing checks)."""
    failures = checks.filter(F.col("status").isin(Q.FAIL, Q.MISSING)).orderBy("category", "check_name")
    return Q.summarize(checks), Q.confidence_tiers(checks, verified), failures
