"""Numeric rules against plain-Python models of the reference's rules (random cases)."""

import math
import random
import re
from decimal import ROUND_HALF_UP, Decimal

from civicstat.functions import numeric as N

RND = random.Random(2024)


def test_pct_half_up_matches_decimal_rounding(spark):
    cases = [(RND.randint(0, 10 ** RND.randint(1, 9)), RND.randint(1, 10 ** RND.randint(1, 9))) for _ in range(500)]
    cases += [(1, 8), (3, 8), (5, 8), (1, 40), (7, 80)]            # exact .x5 boundaries
    df = spark.createDataFrame(cases, "p long, w long")
    got = [r.r for r in df.select(N.pct_half_up("p", "w").alias("r")).collect()]
    want = [float((Decimal(100) * p / w).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)) for p, w in cases]
    assert got == want


def _reference_rule(actual, expected, tol=0.15):
    """The reference's compare(): lenient float, fractional -> strict tolerance, integral -> int()."""
    try:
        a = float(actual) if actual is not None else None
    except ValueError:
        a = None
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return False                                     # NaN: the reference crashes on int(nan); we fail
    frac = isinstance(expected, float) and not expected.is_integer()
    return abs(a - expected) < tol if frac else int(a) == int(expected)


def test_tolerance_rule_matches_reference_model(spark):
    cases = []
    for _ in range(500):
        e = RND.choice([float(RND.randint(0, 1000)), round(RND.uniform(0, 100), RND.randint(1, 2))])
        a = e + RND.choice([0, 0.05, 0.1, 0.14, 0.149, 0.15, 0.151, 0.16, 0.5, 0.9, 1.0, -0.1, -0.149, -0.16])
        cases.append((repr(a), e, isinstance(e, float) and not e.is_integer()))
    df = spark.createDataFrame(cases, "a string, e double, frac boolean")
    got = [r.r for r in df.select(N.tolerance_pass("a", "e", "frac").alias("r")).collect()]
    want = [_reference_rule(a, e) for a, e, _ in cases]
    assert got == want


def test_truncate_matches_int(spark):
    vals = [RND.uniform(-1e6, 1e6) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    assert [r.r for r in df.select(N.truncate("v").alias("r")).collect()] == [int(v) for v in vals]


def test_lenient_double_matches_model(spark):
    pool = ["1", "1.5", " 7 ", "-3", "+4.25", ".5", "5.", "1e3", "2E-2", "abc", "1d", "1_000", "NaN", "inf",
            "", " ", "12 34", "0x10", "--1", "1.2.3"]
    texts = [RND.choice(pool) for _ in range(300)] + pool
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.r for r in df.select(N.lenient_double("t").alias("r")).collect()]
    rx = re.compile(N.NUMERIC_TEXT)
    want = [float(t) if rx.search(t) else None for t in texts]
    assert got == want
