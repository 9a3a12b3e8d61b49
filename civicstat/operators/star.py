"""Star-schema operators.

Joins to dimensions are written as plain equi-joins: Catalyst broadcasts a
side only when its estimated size is under ``autoBroadcastJoinThreshold``
(a checked bound), and AQE switches to a broadcast at runtime when a
shuffled side turns out small; beyond the bound the join stays a
sort-merge join.  Explicit ``broadcast`` is used only for frames whose size
is bounded by construction (a ``limit(k)`` or a one-row aggregate).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
           select: Mapping[str, str | Column] | None = None, how: str = "inner") -> DataFrame:
    """J1 + P1: fact joined to a dimension, optionally projected with renames.

    ``select`` maps output name -> source column (or Column).  Unknown
    foreign keys vanish with ``how='inner'``; pair with ``orphans``.
    """
    joined = fact.join(dim, on, how)
    if select is None:
        return joined
    return joined.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in select.items()])


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no dimension row (NULL keys included).

    Written as ``left_anti``: Catalyst does not turn LEFT JOIN + IS NULL
    into an anti join by itself.  The dimension side is reduced to its
    distinct keys first.
    """
    dim_key = dim_key or fact_key
    keys = dim.select(F.col(dim_key).alias("__k")).distinct()
    return fact.join(keys, fact[fact_key] == keys["__k"], "left_anti")


def presence_flag(dim: DataFrame, refs: DataFrame, key: str,
                  used: str = "USED", unused: str = "UNUSED", alias: str = "status") -> DataFrame:
    """Each dimension row flagged by whether any fact references it."""
    r = refs.select(F.col(key).alias("__ref")).distinct()
    out = dim.join(r, dim[key] == r["__ref"], "left")
    return out.withColumn(alias, F.when(F.col("__ref").isNotNull(), F.lit(used)).otherwise(F.lit(unused))).drop("__ref")


def key_set_diff(actual: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Full outer join of two key sets -> (key, status OK/MISSING/EXTRA)."""
    a = actual.select(F.col(key).alias("__a"), F.lit(True).alias("__in_a")).distinct()
    e = expected.select(F.col(key).alias("__e"), F.lit(True).alias("__in_e")).distinct()
    j = e.join(a, e["__e"].eqNullSafe(a["__a"]), "full_outer")   # a NULL key is a key of its own
    return j.select(
        F.coalesce(F.col("__e"), F.col("__a")).alias(key),
        F.when(F.col("__in_a").isNull(), F.lit("MISSING"))
         .when(F.col("__in_e").isNull(), F.lit("EXTRA"))
         .otherwise(F.lit("OK")).alias("status"))


def group_count(df: DataFrame, by: str | Sequence[str], alias: str = "rows") -> DataFrame:
    """Rows per group (partial aggregation before the shuffle)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(alias))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name of a generated list of frames."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def union_distinct(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION (distinct): one distinct on top, none inside."""
    return union_all(parts).distinct()


def coverage_union(parts: Mapping[str, DataFrame], group_col: str, name_col: str = "table_name",
                   group_alias: str = "community", count_alias: str = "rows") -> DataFrame:
    """A2 + U1: per-table row counts by a dimension attribute, stacked."""
    frames = [group_count(df, group_col, count_alias)
              .select(F.lit(name).alias(name_col), F.col(group_col).alias(group_alias), F.col(count_alias))
              for name, df in parts.items()]
    return union_all(frames)


def sum_by_key(df: DataFrame, key: str | Sequence[str], carried: str | Sequence[str],
               value: str, alias: str) -> DataFrame:
    """A10: sum by a key while carrying a functionally dependent attribute."""
    key = [key] if isinstance(key, str) else list(key)
    carried = [carried] if isinstance(carried, str) else list(carried)
    return df.groupBy(*key, *carried).agg(F.sum(value).alias(alias))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A11."""
    return df.select(*cols).distinct()
