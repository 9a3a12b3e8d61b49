"""Exact order statistics of any number of rows in bounded memory.

``F.median`` keeps every value of a group in one buffer.  Here the range of
the values is cut into buckets; one grouped count tells which bucket holds
the wanted rank, and the next round reads that bucket's range alone, until
it holds one value.  A round shuffles at most ``BUCKETS`` rows a task and
sends as many to the driver.  A range is cut to at most 1 / ``BUCKETS`` of
it in each round, and least and greatest value of a bucket never fall into
the same bucket again, so the rounds end for all values.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import inf, nan

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def order_statistics(df: DataFrame, value: str, ranks: Sequence[int] | None = None, buckets: int = BUCKETS) -> dict[int, float]:
    """Values of 0-based ``ranks`` (of both middle ranks without any) in ascending order, NULLs left out.

    -inf comes first, NaN after all numbers, as Spark sorts.  A rank beyond
    the rows raises IndexError.
    """
    x = df.select(F.col(value).cast("double").alias("x")).where("x is not null")
    finite = ~F.isnan("x") & (F.abs("x") < inf)
    n, low, high, least, most, above = x.agg(
        F.count(F.lit(1)), F.count_if(F.col("x") == -inf), F.count_if((F.col("x") == inf)),
        F.min(F.when(finite, F.col("x"))), F.max(F.when(finite, F.col("x"))), F.count_if(F.isnan("x"))).first()
    if ranks is None:
        ranks = [(n - 1) // 2, n // 2] if n else []
    if any(not 0 <= r < n for r in ranks):
        raise IndexError(f"ranks {list(ranks)} of {n} values")
    found, open_ = {}, {}
    for r in ranks:
        if r < low:
            found[r] = -inf
        elif r >= n - above:
            found[r] = nan
        elif r >= n - above - high:
            found[r] = inf
        else:
            open_[r] = (r - low, least, most)  # rank in a range of values
    while open_:
        for r in [r for r, (_, lo, hi) in open_.items() if lo == hi]:
            found[r] = open_.pop(r)[1]
        ranges = sorted({(lo, hi) for _, lo, hi in open_.values()})
        if not ranges:
            break
        place = F.lit(None).cast("string")
        for lo, hi in ranges:
            wide = hi - lo == inf  # then by halves, whose difference is a number
            share = (F.col("x") / 2 - lo / 2) / F.lit(hi / 2 - lo / 2) if wide else (F.col("x") - lo) / F.lit(hi - lo)
            bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")
            place = F.when(F.col("x").between(lo, hi), F.concat_ws(":", F.lit(str(ranges.index((lo, hi)))), F.lpad(bucket.cast("string"), 9, "0"))).otherwise(place)
        counted = (x.where(" or ".join(f"x between {lo!r}D and {hi!r}D" for lo, hi in ranges)).groupBy(place.alias("place"))
                   .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).orderBy("place").collect())
        for r, (rank, lo, hi) in list(open_.items()):
            own = f"{ranges.index((lo, hi))}:"
            for row in counted:
                if row.place.startswith(own):
                    if rank < row.n:
                        open_[r] = (rank, row.lo, row.hi)
                        break
                    rank -= row.n
    return found


def exact_median(df: DataFrame, value: str) -> float | None:
    """The interpolated median; None without values."""
    middle = sorted(order_statistics(df, value).items())
    if not middle:
        return None
    lo, hi = middle[0][1], middle[-1][1]
    return lo if lo == hi else lo + (hi - lo) * 0.5


def above_exact_median(df: DataFrame, value: str, alias: str = "above_median") -> DataFrame:
    """A15 on rows: flag values strictly above the median; NULL for a NULL value or without a median."""
    median = exact_median(df, value)
    return df.withColumn(alias, F.col(value) > F.lit(median).cast("double"))
