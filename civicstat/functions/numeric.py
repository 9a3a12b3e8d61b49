"""Numeric rules (P16, F6, F7, F10, F11, F13) as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or scientific notation with optional surrounding blanks.
# Text outside this shape is not a number (e.g. 'NaN', '1d', '1_000'), which
# keeps the lenient cast identical across engines.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

DEFAULT_TOLERANCE = 0.15


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(col) -> Column:
    """Text or number -> double; NULL for NULL or non-numeric text."""
    s = _c(col).cast("string")
    return F.when(s.rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))


def as_double(df, name: str) -> Column:
    """Column ``name`` of ``df`` as double: numeric types cast directly, text leniently."""
    from pyspark.sql.types import NumericType
    if isinstance(df.schema[name].dataType, NumericType):
        return F.col(name).cast("double")
    return lenient_double(name)


def truncate(col) -> Column:
    """truncate toward zero (int(x)); NULL for NaN/inf/out of range."""
    return _c(col).try_cast("bigint")


def safe_ratio(num, den) -> Column:
    """division that yields NULL for a zero denominator (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def pct(num, den, decimals: int = 1) -> Column:
    """ROUND(100 * num / den, d) computed in double, HALF_UP."""
    return F.round(F.try_divide(_c(num).cast("double") * F.lit(100.0), _c(den).cast("double")), decimals)


def pct_half_up(part, whole, decimals: int = 1) -> Column:
    """Percent of two integer counts rounded half up, computed exactly.

    ``round(100 * part / whole, d)`` in integer arithmetic, so the result
    does not depend on binary floating point at the rounding boundary.
    NULL when ``whole`` is 0.
    """
    scale = 10 ** decimals
    p = _c(part).cast("bigint")
    w = _c(whole).cast("bigint")
    num = F.lit(200 * scale).cast("bigint") * p + w
    den = F.lit(2).cast("bigint") * w
    q = F.call_function("div", num, den)   # integer division; counts are not negative
    return F.when(w != 0, q.cast("double") / F.lit(float(scale)))


def exact_mean(col, scale: int = 6) -> Column:
    """Mean that does not depend on row order: sum as DECIMAL(38, scale), then divide.

    A double sum's last bits depend on the order partitions are combined;
    values with at most ``scale`` decimals are summed exactly.  NULLs are
    skipped like ``avg``.
    """
    c = _c(col)
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double") / F.count(c)


def is_fractional(expected) -> Column:
    """True when an expected value has a fractional part (tolerance rule)."""
    e = _c(expected)
    return e != F.floor(e)


def tolerance_pass(actual, expected, fractional=None, tolerance: float = DEFAULT_TOLERANCE) -> Column:
    """typed tolerance comparison.

    * actual NULL, non-numeric or NaN -> False
    * fractional expectation -> ``abs(a - e) < tolerance`` (strict)
    * integral expectation (int, or a float such as 5.0) -> ``int(a) == int(e)``
      with truncation toward zero, so 5.9 passes against 5.0
    """
    a = lenient_double(actual)
    e = _c(expected).cast("double")
    frac = is_fractional(e) if fractional is None else _c(fractional)
    return (F.when(a.isNull() | F.isnan(a), F.lit(False))
            .when(frac, F.abs(a - e) < F.lit(tolerance))
            .otherwise(F.coalesce(truncate(a) == truncate(e), F.lit(False))))


def within(a, b, bound: float) -> Column:
    """``abs(int(a) - int(b)) <= bound``."""
    return F.abs(truncate(a) - truncate(b)) <= F.lit(bound)
