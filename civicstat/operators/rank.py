"""Ordering, top-k and "latest" operators.

"Latest per group" is an aggregate (max of a struct ordered by period and
tie-breakers), not a window: it combines map-side, so a group holding a
third of all rows still reduces to one row per map task before the shuffle.
Global maxima and medians are one-row scalar subqueries, never a window
without PARTITION BY (which would move all rows to one task).
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.functions.labels import category_ordinal


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def with_ordinal(df: DataFrame, col: str, categories: Sequence[str], alias: str) -> DataFrame:
    """O2: ordinal column from an ordered category list (unknown -> NULL)."""
    return df.withColumn(alias, category_ordinal(col, categories))


def group_totals(df: DataFrame, group: str | Sequence[str], value: str | Column,
                 how: str = "sum", alias: str = "total") -> DataFrame:
    """Per-group sum or mean."""
    v = F.col(value) if isinstance(value, str) else value
    fn = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min}[how]
    return df.groupBy(*_list(group)).agg(fn(v).alias(alias))


def top_k(df: DataFrame, group: str | Sequence[str], value: str | Column, k: int,
          how: str = "sum", alias: str = "total") -> DataFrame:
    """The k largest groups by an aggregate; ties keep the smaller key.

    ``orderBy().limit(k)`` plans as TakeOrderedAndProject: every partition
    keeps its own top k, so only k rows per partition reach the final step.
    """
    g = _list(group)
    totals = group_totals(df, g, value, how, alias)
    return totals.orderBy(F.col(alias).desc_nulls_last(), *[F.col(c).asc() for c in g]).limit(k)


def keep_top_k(df: DataFrame, group: str | Sequence[str], value: str | Column, k: int,
               how: str = "sum") -> DataFrame:
    """O4 + J8: rows of the k largest groups (semi join to a k-row frame)."""
    g = _list(group)
    keys = top_k(df, g, value, k, how).select(*g)
    return df.join(F.broadcast(keys), g, "left_semi")


def latest_per_group(df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str],
                     payload: Sequence[str], tiebreak: Sequence[str] = (),
                     status: str | None = None) -> DataFrame:
    """The row with the greatest ``order`` (then ``tiebreak``) per group.

    A row with a NULL in any order column (a non-year period) never wins over
    a dated row.  A group without any dated row keeps one row, with NULL order
    columns and ``dated`` false where ``status`` names that column.  Returns
    keys + order + tiebreak + payload columns (+ ``status``).
    """
    k = _list(keys)
    o = _list(order)
    cols = o + [c for c in tiebreak if c not in o] + [c for c in payload if c not in o and c not in tiebreak]
    dated = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in o])
    best = df.groupBy(*k).agg(F.max(F.struct(dated.alias("__dated"), *cols)).alias("__best"))
    kept = [F.when(F.col("__best.__dated"), F.col(f"__best.{c}")).alias(c) if c in o else F.col(f"__best.{c}").alias(c)
            for c in cols]
    return best.select(*k, *kept, *([F.col("__best.__dated").alias(status)] if status else []))


def _shared(df: DataFrame, share_input: bool) -> DataFrame:
    # A scalar subquery and the main plan each evaluate ``df``; for a small
    # but expensive input (a selection of a derived table) a reliable
    # checkpoint in the shared folder lets both read it once computed.
    if not share_input:
        return df
    from civicstat.session import materialize
    return materialize(df)


def latest_global(df: DataFrame, order: str, share_input: bool = False) -> DataFrame:
    """Rows at the globally latest period (scalar subquery, no window).

    Groups lacking that period disappear, as in the reference.
    ``share_input`` checkpoints a small, expensive input so it is computed once.
    """
    df = _shared(df, share_input)
    newest = df.select(F.max(order)).scalar()
    return df.filter(F.col(order) == newest)


def above_median(df: DataFrame, value: str, alias: str = "above_median",
                 exact: bool = True, accuracy: int = 10000, share_input: bool = False) -> DataFrame:
    """Flag rows strictly above the median of ``value``.

    ``exact`` uses the interpolated median (pandas semantics); it holds all
    values of the column in one aggregation buffer, so use it on aggregated
    frames (one row per group).  ``exact=False`` uses a bounded-memory
    quantile sketch (``percentile_approx``) for unbounded inputs.
    """
    df = _shared(df, share_input)
    m = F.median(value) if exact else F.percentile_approx(value, 0.5, accuracy)
    med = df.select(m).scalar()
    return df.withColumn(alias, F.col(value) > med)


def sort_typed(df: DataFrame, value: str, numeric: Column, ascending: bool = False) -> DataFrame:
    """Sort by the numeric value, not its text."""
    d = df.withColumn(value, numeric)
    return d.orderBy(F.col(value).asc_nulls_first() if ascending else F.col(value).desc_nulls_last())
