"""Long indicator table (section, geography, characteristic, period, value).

Selection (P3-P14, P17), period parsing and value normalisation.  Periods
are text (``'2011'``, but also ``'Percentage of all HHs'``), so ordering by
the text is wrong whenever a non-year value occurs: ``year`` is parsed once
and used for every "latest"/min/max decision.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicstat.functions.numeric import lenient_double

SECTION = "dashboard_section"
GEOGRAPHY = "geography"
GEOGRAPHY_ID = "geography_id"
GEOGRAPHY_TYPE = "geography_type"
CHARACTERISTIC = "characteristic"
TIMEFRAME = "timeframe"
VALUE = "indicator_value"
SOURCE = "data_source"

LONG_COLUMNS = (SECTION, GEOGRAPHY, GEOGRAPHY_ID, GEOGRAPHY_TYPE, CHARACTERISTIC, TIMEFRAME, VALUE, SOURCE)

YEAR_TEXT = r"^[0-9]{4}$"


def parse_year(col=TIMEFRAME) -> Column:
    """Year of a text period; NULL for non-year periods."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike(YEAR_TEXT), c.cast("int"))


def with_year(df: DataFrame, col: str = TIMEFRAME, alias: str = "year") -> DataFrame:
    return df.withColumn(alias, parse_year(col))


def normalise_value(df: DataFrame, col: str = VALUE) -> DataFrame:
    """Value arrives as text or decimal; normalise once to double.

    Numeric columns are cast directly; text goes through the lenient cast
    (non-numeric text -> NULL instead of an error).
    """
    from pyspark.sql.types import NumericType
    if isinstance(df.schema[col].dataType, NumericType):
        return df.withColumn(col, F.col(col).cast("double"))
    return df.withColumn(col, lenient_double(col))


def select_indicators(df: DataFrame, section: str | None = None,
                      characteristics: Sequence[str] | None = None,
                      like: str | Sequence[str] | None = None,
                      any_like: Sequence[str] | None = None,
                      not_like: str | Sequence[str] | None = None,
                      periods: Sequence[str] | None = None,
                      geographies: Sequence[str] | None = None,
                      non_null: bool = False) -> DataFrame:
    """Conjunctive selection on a long table.

    ``like`` patterns are ANDed, ``any_like`` patterns ORed (one row per
    match, no duplicates), ``not_like`` excluded.  All are native
    predicates; Catalyst turns prefix/suffix/infix LIKE into
    StartsWith/EndsWith/Contains and pushes them to the parquet scan.
    """
    cond = F.lit(True)
    if section is not None:
        cond = cond & (F.col(SECTION) == F.lit(section))
    if characteristics is not None:
        cond = cond & F.col(CHARACTERISTIC).isin(list(characteristics))
    for p in ([like] if isinstance(like, str) else (like or [])):
        cond = cond & F.col(CHARACTERISTIC).like(p)
    if any_like:
        anyc = F.lit(False)
        for p in any_like:
            anyc = anyc | F.col(CHARACTERISTIC).like(p)
        cond = cond & anyc
    for p in ([not_like] if isinstance(not_like, str) else (not_like or [])):
        cond = cond & ~F.col(CHARACTERISTIC).like(p)
    if periods is not None:
        cond = cond & F.col(TIMEFRAME).isin(list(periods))
    if geographies is not None:
        cond = cond & F.col(GEOGRAPHY).isin(list(geographies))
    if non_null:
        cond = cond & F.col(VALUE).isNotNull()
    return df.filter(cond)


def fallback_select(df: DataFrame, predicates: Sequence[Column], share_input: bool = False) -> DataFrame:
    """Rows of the first predicate (in order) that selects anything.

    Each row is tagged with the index of the first predicate it satisfies;
    the rows at the smallest tier present are kept.  The minimum is a
    one-row scalar subquery, so there is no driver-side branch and no
    extra pass of the data through the driver.
    """
    tier = None
    for i, p in enumerate(predicates):
        tier = F.when(p, F.lit(i)) if tier is None else tier.when(p, F.lit(i))
    tagged = df.withColumn("__tier", tier).filter(F.col("__tier").isNotNull())
    if share_input:   # the subquery and the main plan then read one computed input
        from civicstat.session import materialize
        tagged = materialize(tagged)
    best = tagged.select(F.min("__tier")).scalar()
    return tagged.filter(F.col("__tier") == best).drop("__tier")
