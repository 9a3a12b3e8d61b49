"""Runs of present and absent periods of each series.

A series' periods are integers (years, days).  Distinct periods of a series
less their ranks are equal within a run (gaps and islands), so present runs
are one grouped aggregate over a window by series; absent runs lie between
a period and the next one.  A window holds the distinct periods of one
series, at most the length of the calendar, however many rows the series has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _periods(df: DataFrame, keys: Sequence[str], period: Column) -> DataFrame:
    return df.select(*keys, period.cast("long").alias("period")).where("period is not null").distinct()


def present_runs(df: DataFrame, keys: Sequence[str], period: Column) -> DataFrame:
    """Islands: keys, first, last and length of each run of periods without a gap."""
    seen = _periods(df, keys, period)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("period"))
    runs = seen.withColumn("run", F.col("period") - rank).groupBy(*keys, "run").agg(
        F.min("period").alias("first"), F.max("period").alias("last"), F.count(F.lit(1)).alias("length"))
    return runs.drop("run")


def absent_runs(df: DataFrame, keys: Sequence[str], period: Column, first: int | Column | None = None,
                last: int | Column | None = None, series: DataFrame | None = None) -> DataFrame:
    """Gaps: keys, place, first, last and length of each run of absent periods.

    The calendar goes from ``first`` to ``last``, without these from the
    least to the greatest period of all series.  place is 'leading' (before
    a series begins), 'inner', 'trailing' (a stale series) or 'whole': a
    row of ``series`` (the keys that there should be) without any period.
    """
    seen = _periods(df, keys, period)
    ends = seen.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    lo = ends.select("lo").scalar() if first is None else (F.lit(first).cast("long") if isinstance(first, int) else first)
    hi = ends.select("hi").scalar() if last is None else (F.lit(last).cast("long") if isinstance(last, int) else last)
    seen = seen.where((F.col("period") >= lo) & (F.col("period") <= hi))
    after = F.lead("period").over(Window.partitionBy(*keys).orderBy("period"))
    inner = seen.withColumn("after", after).where("after > period + 1").select(
        *keys, F.lit("inner").alias("place"), (F.col("period") + 1).alias("first"), (F.col("after") - 1).alias("last"))
    span = seen.groupBy(*keys).agg(F.min("period").alias("begin"), F.max("period").alias("end"))
    leading = span.where(F.col("begin") > lo).select(*keys, F.lit("leading").alias("place"), lo.alias("first"), (F.col("begin") - 1).alias("last"))
    trailing = span.where(F.col("end") < hi).select(*keys, F.lit("trailing").alias("place"), (F.col("end") + 1).alias("first"), hi.alias("last"))
    out = inner.unionByName(leading).unionByName(trailing)
    if series is not None:
        none = series.select(*keys).distinct().join(span, list(keys), "left_anti")
        out = out.unionByName(none.select(*keys, F.lit("whole").alias("place"), lo.alias("first"), hi.alias("last")))
    return out.withColumn("length", F.col("last") - F.col("first") + 1)


def range_text(first: str = "first", last: str = "last") -> Column:
    """A run as text: '2012 to 2020', or '2012' for one period."""
    return F.when(F.col(first) == F.col(last), F.col(first).cast("string")).otherwise(
        F.concat(F.col(first).cast("string"), F.lit(" to "), F.col(last).cast("string")))
