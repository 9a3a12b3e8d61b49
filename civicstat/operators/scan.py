"""Counts for many checks, with one scan of each table.

A check of a table needs either the number of its rows that meet a predicate
(``Count``: row counts, NULLs, values out of bounds) or the keys of one column
that are absent from others (``Lookup``: orphans, references never used).
``scan_once`` takes all of them, stacks what each row of a table has to tell,
and sums everything in one grouping by (number of the question, key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INTEGRAL = ("tinyint", "smallint", "int", "bigint")

FACT_SCHEMA = "kind string, subject string, column string, n long"


@dataclass(frozen=True)
class Count:
    """Rows of ``table`` that meet ``where`` (None: all), reported as (kind, table, column)."""

    kind: str
    table: str
    column: str | None = None
    where: Column | None = None


@dataclass(frozen=True)
class Lookup:
    """Rows (or ``distinct`` keys) of one column whose key is NULL or in none of ``known``, reported as (kind, subject, column).

    ``of`` and the members of ``known`` are (table, column).
    """

    kind: str
    subject: str
    of: tuple[str, str]
    known: Sequence[tuple[str, str]]
    distinct: bool = False


def scan_once(tables: Mapping[str, DataFrame], asked: Sequence[Count | Lookup]) -> DataFrame:
    """(kind, subject, column, n): one row for each of ``asked``; each table is scanned once.

    Each row of a table is stacked into one row for each question that it
    takes part in and summed on the map side, so a hot key sends one row a
    task and counts send one row a task each.  No join: what is looked up and
    what it is looked up in meet in the grouping.  Keys are long where all
    that are used are integral, else text.  A table that is empty has a zero.
    """
    uses: dict[str, list[tuple[int, Column, Column, bool]]] = {}
    columns = {c for a in asked if isinstance(a, Lookup) for c in (a.of, *a.known)}
    integral = {tables[t].schema[c].dataType.simpleString() for t, c in columns} <= set(_INTEGRAL)
    kind = "bigint" if integral else "string"
    for i, a in enumerate(asked):
        if isinstance(a, Count):
            hit = F.lit(True) if a.where is None else F.coalesce(a.where, F.lit(False))
            uses.setdefault(a.table, []).append((i, F.lit(None).cast(kind), hit.cast("long"), False))
        else:
            uses.setdefault(a.of[0], []).append((i, F.col(a.of[1]).cast(kind), F.lit(1).cast("long"), False))
            for t, c in a.known:
                uses.setdefault(t, []).append((i, F.col(c).cast(kind), F.lit(0).cast("long"), True))
    stacked = [tables[t].select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("q"), key.alias("key"), n.alias("n"), F.lit(known).alias("known")) for i, key, n, known in told])))
        for t, told in uses.items()]
    met = reduce(lambda x, y: x.unionByName(y), stacked).groupBy("q", "key").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    once = F.col("q").isin([i for i, a in enumerate(asked) if isinstance(a, Lookup) and a.distinct])
    lost = F.when(F.col("key").isNull() | ~F.col("known"), F.when(once, F.least("n", F.lit(1))).otherwise(F.col("n")))
    counts = met.groupBy("q").agg(F.sum(lost).alias("n"))
    names = [(a.kind, a.table, a.column) if isinstance(a, Count) else (a.kind, a.subject, a.of[1]) for a in asked]
    listed = F.array(*[F.struct(F.lit(i).alias("of"), F.lit(k).alias("kind"), F.lit(s).alias("subject"), F.lit(c).cast("string").alias("column"))
                       for i, (k, s, c) in enumerate(names)])
    every = counts.sparkSession.range(1).select(F.inline(listed))
    return every.join(counts, F.col("of") == F.col("q"), "left").select("kind", "subject", "column", F.coalesce("n", F.lit(0).cast("long")).alias("n"))
