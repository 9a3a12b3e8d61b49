"""Co-located storage: the driver tables bucketed by their join keys.

Facts that are joined or anti-joined on the same key are written with the
same number of buckets, bucketed and sorted by that key.  Spark then plans
the join bucket-to-bucket: a sort-merge join with no exchange on either
side, so the largest joins of the validator and of the IND build stop
shuffling.  Load the copy with ``load(spark, "table:<database>", name)``
(every registered query accepts that root in place of a parquet folder).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from civicstat.sources.tables import load

# table -> bucketing key (the key it is joined on most)
JOIN_KEYS = {
    "customer": "c_custkey",
    "orders": "o_custkey",
    "lineitem": "l_orderkey",
}


def write_bucketed(df: DataFrame, table: str, by: str | Sequence[str], buckets: int,
                   mode: str = "overwrite") -> None:
    cols = [by] if isinstance(by, str) else list(by)
    df.write.mode(mode).bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(table)


def bucketed_copy(spark: SparkSession, sf_dir: str, database: str, buckets: int,
                  keys: Mapping[str, str] = JOIN_KEYS, others: Sequence[str] = ()) -> str:
    """Write the tables of ``sf_dir`` into ``database``; returns the load root."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, key in keys.items():
        write_bucketed(load(spark, sf_dir, name), f"{database}.{name}", key, buckets)
    for name in others:
        load(spark, sf_dir, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")
    return f"table:{database}"
