"""The place of a row in an order, as data.

``row_number`` without keys takes all rows to one task.  Here range
partitions are sorted each for itself, a row's position is its place in its
partition plus the rows of the partitions before, and only the counts of the
partitions meet: one number for each.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.session import materialize


def with_position(df: DataFrame, order: Sequence[Column], alias: str = "position") -> DataFrame:
    """``df`` and each row's 1-based position by ``order``.

    ``order`` should tell all rows apart; rows that it doesn't get positions
    next to each other in any order.  The sorted rows are checkpointed, so
    that counts and positions come from the same partitions.
    """
    place = F.monotonically_increasing_id()
    rows = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", place))
    part = F.shiftright("__place", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    before = [0, *accumulate(c["n"] for c in counts)]
    shifts = df.sparkSession.createDataFrame([(c["part"], b) for c, b in zip(counts, before)], "part long, shift long")
    within = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each partition
    joined = rows.withColumn("__part", part).join(F.broadcast(shifts), F.col("__part") == F.col("part"))
    return joined.withColumn(alias, within + F.col("shift") + 1).drop("__place", "__part", "part", "shift")
