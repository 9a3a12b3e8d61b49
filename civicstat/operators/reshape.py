"""Reshaping (A16-A20, W3-W5, O5, O6, unpivot).

Pivots take an explicit, sorted value list (O6): Spark then needs no extra
distinct job to discover the columns, an absent value still yields its
(all-null) column (P19), and the output schema is stable.  Pivoting is a
grouped aggregation, so it partially aggregates before the shuffle and a
hot index value does not pile up rows in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _rename(df: DataFrame, values: Sequence, aliases: Mapping | Sequence | None) -> tuple[DataFrame, list[str]]:
    names = [str(v) for v in values]
    if aliases is None:
        return df, names
    if not isinstance(aliases, Mapping):
        aliases = dict(zip(values, aliases))
    out = df
    new = []
    for v, n in zip(values, names):
        a = aliases.get(v, n)
        out = out.withColumnRenamed(n, a)
        new.append(a)
    return out, new


def pivot_values(df: DataFrame, column: str, max_values: int = 10000) -> list:
    """Sorted distinct values of a pivot column (one small distinct job).

    A pivot column is a dimension attribute; more than ``max_values``
    distinct values (Spark's own pivot limit) raises instead of silently
    truncating the column list, and so does a NULL, which names no column.
    """
    vals = [r[0] for r in df.select(column).distinct().limit(max_values + 1).collect()]
    if len(vals) > max_values:
        raise ValueError(f"pivot column {column!r} has more than {max_values} distinct values")
    if None in vals:
        raise ValueError(f"pivot column {column!r} holds NULL; filter or label it first")
    return sorted(vals)


def pivot_unique(df: DataFrame, index: str | Sequence[str], column: str, value: str,
                 values: Sequence, aliases: Mapping | Sequence | None = None,
                 fill=None) -> DataFrame:
    """Long -> wide where each (index, column) cell holds one row.

    A cell with several rows is an error; ``duplicate_cells`` reports them.  ``fill`` replaces absent cells (A20); leave
    it None for comparison tables, where absent and zero differ.
    """
    wide = df.groupBy(*_list(index)).pivot(column, list(values)).agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("a pivot cell holds several rows"))).otherwise(F.max(value)))
    wide, cols = _rename(wide, values, aliases)
    if fill is not None:
        wide = wide.na.fill(fill, subset=cols)
    return wide


def duplicate_cells(df: DataFrame, index: str | Sequence[str], column: str,
                    alias: str = "n_rows") -> DataFrame:
    """A16 'report' mode: (index, column) cells holding more than one row."""
    return (df.groupBy(*_list(index), column).agg(F.count(F.lit(1)).alias(alias))
            .filter(F.col(alias) > 1))


def assert_unique_cells(df: DataFrame, index: str | Sequence[str], column: str) -> None:
    """A16 'error' mode: raise when any cell is duplicated (one small job)."""
    if not duplicate_cells(df, index, column).isEmpty():
        raise ValueError(f"duplicate pivot cells for index={index} column={column}")


def pivot_agg(df: DataFrame, index: str | Sequence[str], column: str, agg: Column,
              values: Sequence, aliases: Mapping | Sequence | None = None, fill=None) -> DataFrame:
    """Pivot with an aggregate (mean, sum, ...)."""
    wide = df.groupBy(*_list(index)).pivot(column, list(values)).agg(agg)
    wide, cols = _rename(wide, values, aliases)
    if fill is not None:
        wide = wide.na.fill(fill, subset=cols)
    return wide


def pivot_latest(df: DataFrame, index: str | Sequence[str], column: str, value: str, order: str,
                 values: Sequence, aliases: Mapping | Sequence | None = None, fill=None) -> DataFrame:
    """Per cell the latest non-null value by ``order`` (e.g. parsed year).

    NULL values are dropped first: ``max_by`` would otherwise return the
    newest row's NULL.
    """
    return pivot_agg(df.filter(F.col(value).isNotNull()), index, column,
                     F.max_by(value, order), values, aliases, fill)


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            variable: str = "column", value: str = "actual") -> DataFrame:
    """Wide -> long (used by truth checks, J7)."""
    return df.unpivot(list(ids), list(values), variable, value)


def stack_offsets(df: DataFrame, group: str | Sequence[str], order: str | Sequence[str],
                  value: str, alias: str = "offset") -> DataFrame:
    """Running sum of earlier categories within a group (stack base).

    Input is the aggregated cell table (one row per group and category),
    so a window partition holds at most the number of categories.
    """
    w = (Window.partitionBy(*_list(group)).orderBy(*_list(order))
         .rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(alias, F.coalesce(F.sum(F.coalesce(F.col(value), F.lit(0))).over(w), F.lit(0)))


def mean_series(df: DataFrame, keys: Sequence[str], value: str, alias: str = "mean_value") -> DataFrame:
    """Mean per (group, period), NULLs skipped."""
    return df.groupBy(*keys).agg(F.avg(value).alias(alias))


def ordered_series(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ordered by (group, period) with a distributed range sort."""
    return df.orderBy(*keys)
