"""Expected-value relations.

Nested truth dictionaries (subject -> column -> value, or subject -> period
-> value) become one long frame ``(subject, period, column, expected,
is_fractional)`` so that checks are a join, not a driver loop.  Expected
relations are tiny and bounded by the literal size, so they are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TRUTH_SCHEMA = T.StructType([
    T.StructField("subject", T.StringType(), False),
    T.StructField("period", T.StringType(), True),
    T.StructField("column", T.StringType(), False),
    T.StructField("expected", T.DoubleType(), False),
    T.StructField("is_fractional", T.BooleanType(), False),
])


def _fractional(v) -> bool:
    # an int, or a float with no fractional part, is compared as an integer
    return isinstance(v, float) and not float(v).is_integer()


def truth_frame(spark: SparkSession, truth: Mapping, nested_period: bool = False) -> DataFrame:
    """Flatten ``{subject: {column: v}}`` or ``{subject: {period: {column: v}}}``."""
    rows = []
    for subject, inner in truth.items():
        for k, v in inner.items():
            if nested_period:
                for col, val in v.items():
                    rows.append((str(subject), str(k), str(col), float(val), _fractional(val)))
            else:
                rows.append((str(subject), None, str(k), float(v), _fractional(v)))
    return spark.createDataFrame(rows, TRUTH_SCHEMA).coalesce(1)   # literal-sized: one partition


def expected_counts(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    schema = T.StructType([
        T.StructField("table_name", T.StringType(), False),
        T.StructField("expected_rows", T.LongType(), False),
    ])
    return spark.createDataFrame([(k, int(v)) for k, v in counts.items()], schema).coalesce(1)
