"""Label and text helpers (F1-F5, F8, F9, F12, G7) as native Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed category orders (values that must equal the reference's, in its order).
INCOME_TIER_ORDER = ("very_low", "low", "moderate", "median", "high")
COST_BAND_ORDER = ("under_500", "r500_999", "r1000_1499", "r1500_1999", "r2000_plus")
INCOME_BAND_ORDER = ("under_20k", "r20k_40k", "r40k_60k", "r60k_80k", "r80k_100k", "over_100k")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_ordinal(col, categories: Sequence[str]) -> Column:
    """F1/O2: 1-based position of a label in an ordered list.

    A label outside the list gives NULL (a CASE without ELSE), which sorts
    first ascending like the reference's ORDER BY CASE.
    """
    arr = F.array(*[F.lit(c) for c in categories])
    return F.nullif(F.array_position(arr, _c(col)), F.lit(0)).cast("int")


def case_like(col, rules: Sequence[tuple[str, str]], otherwise: Column) -> Column:
    """searched CASE: first LIKE pattern that matches gives its label."""
    expr = None
    for pattern, label in rules:
        cond = _c(col).like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return otherwise if expr is None else expr.otherwise(otherwise)


def first_token(col, delimiter: str = ",") -> Column:
    """``SPLIT(c, d)[0]``; NULL (not an error) when out of range."""
    return F.get(F.split(_c(col), delimiter), 0)


def strip_literals(col, fragments: Sequence[str]) -> Column:
    """remove literal fragments, all occurrences, applied in order."""
    out = _c(col)
    for frag in fragments:
        out = F.replace(out, F.lit(frag), F.lit(""))
    return out


def map_with_fallback(col, mapping: Mapping[str, str]) -> Column:
    """code -> label, the code itself when unmapped."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(m, _c(col)), _c(col))


def number_text(col, decimals: int = 0) -> Column:
    """F8: thousands separators, half-even rounding (``{x:,.0f}``)."""
    return F.format_number(_c(col), decimals)


def percent_text(col, decimals: int = 1) -> Column:
    """F8: ``{x:.1f}%``, without thousands separators."""
    return F.concat(F.replace(F.format_number(_c(col), decimals), F.lit(",")), F.lit("%"))


def currency_text(col, decimals: int = 0) -> Column:
    """F8: ``${x:,.0f}``."""
    return F.concat(F.lit("$"), F.format_number(_c(col), decimals))


def contains_ci(col, needle: str) -> Column:
    """case-insensitive substring test."""
    return F.lower(_c(col)).contains(needle.lower())


def clean_geography_name(col) -> Column:
    """G7 fallback text clean-up of a display name.

    Drops a trailing ``(...)`` group with anything after it (codes, appended
    statistics), a ``, Type`` suffix and repeated blanks.  Standardisation by
    id (``coalesce(dim.name, clean(name))``) takes precedence over this.
    """
    s = F.regexp_replace(_c(col), r"\s*\(.*$", "")
    s = F.regexp_replace(s, r",.*$", "")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.trim(s)
