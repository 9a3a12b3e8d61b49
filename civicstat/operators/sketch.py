"""Profiles from mergeable sketches of distinct values.

An exact count of distinct values keeps every value until the last step, and
a rollup of several such counts expands each row by their number.  Here each
(group, file) leaves one row: counts, extremes and a HyperLogLog sketch of
each column.  These rows can be stored, files that are added later need only
their own, and groups and grand totals are merged from the rows alone.

A sketch of 2**k registers has a relative standard error of
1.04 / sqrt(2**k) after merging, whatever the number of values; ``bound`` is
three times that.  Exact counts (``operators.profile``) stay the default.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14
_SKETCH = "sketch_"


def bound(lg_k: int = LG_K) -> float:
    """Relative error that an estimate stays within, but for 3 cases in 1000."""
    return 3 * 1.04 / sqrt(2 ** lg_k)


def sketch_rows(df: DataFrame, keys: Sequence[str], distinct: Mapping[str, Column], value: str | None = None,
                extremes: Mapping[str, Column] | None = None, lg_k: int = LG_K, by_file: bool = True) -> DataFrame:
    """One row for each group and input file: what a profile of any union of them needs.

    ``distinct`` maps names to columns whose distinct values count; NULLs
    don't.  ``value`` adds a count of its NULLs, ``extremes`` least and
    greatest values.  Without ``by_file`` there is one row a group.
    """
    parts = [F.count(F.lit(1)).alias("row_count")]
    if value is not None:
        parts.append(F.count_if(F.col(value).isNull()).alias("null_values"))
    for name, col in (extremes or {}).items():
        parts += [F.min(col).alias(f"first_{name}"), F.max(col).alias(f"last_{name}")]
    for name, col in distinct.items():
        parts.append(F.hll_sketch_agg(col.cast("string"), lg_k).alias(_SKETCH + name))
    files = [F.input_file_name().alias("file")] if by_file else []
    return df.groupBy(*keys, *files).agg(*parts)


def merge_sketches(rows: DataFrame, keys: Sequence[str], total: str | None = None) -> DataFrame:
    """Rows of ``sketch_rows`` merged by ``keys``, still mergeable.

    ``total`` names a column that adds the grand total (true there): a rollup
    over the few stored rows, not over the data.
    """
    parts = []
    for c in rows.columns:
        if c in ("row_count", "null_values"):
            parts.append(F.sum(c).alias(c))
        elif c.startswith("first_"):
            parts.append(F.min(c).alias(c))
        elif c.startswith("last_"):
            parts.append(F.max(c).alias(c))
        elif c.startswith(_SKETCH):
            parts.append(F.hll_union_agg(c).alias(c))
    if total is None:
        return rows.groupBy(*keys).agg(*parts)
    sets = rows.groupingSets([list(keys), []], *keys)
    return sets.agg(*parts, (F.grouping_id() > 0).alias(total))


def estimates(merged: DataFrame) -> DataFrame:
    """The sketches of merged rows as numbers of distinct values."""
    return merged.select(*[F.hll_sketch_estimate(c).alias(c[len(_SKETCH):]) if c.startswith(_SKETCH) else F.col(c)
                           for c in merged.columns])


def density(merged: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Rows over the product of the distinct values of ``cell``."""
    e = estimates(merged)
    cells = F.lit(1.0)
    for c in cell:
        cells = cells * F.col(c)
    return e.withColumn("expected_cells", cells).withColumn("density", F.try_divide(F.col("row_count"), F.col("expected_cells")))
