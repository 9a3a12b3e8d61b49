"""Every query on the physical paths a large cluster takes, against its oracle.

Small test tables make Spark broadcast every dimension.  Here broadcasting
is switched off and AQE's skew thresholds are set tiny, so joins run as
sort-merge joins (with skewed partitions split) as they would at 100 TB,
and the results must still equal the DuckDB oracle.
"""

import duckdb
import pytest

import __spark_entry__ as E
from civicstat.plans.registry import all_queries
from tests.conftest import SF_SMALL
from tests.test_queries import TABLES, canon

QUERIES = {name: q.build for name, q in all_queries().items()}
ORACLE = {name: q.sql for name, q in all_queries().items() if q.sql}

SCALE_PATH_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture(scope="module")
def scale_spark(spark):
    old = {k: spark.conf.get(k, None) for k in SCALE_PATH_CONF}
    for k, v in SCALE_PATH_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_shuffle_join_path(scale_spark, con, name):
    sdf = QUERIES[name](scale_spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert canon(sdf.columns, srows) == canon(dcols, res.fetchall())


def test_no_broadcast_on_this_path(scale_spark):
    import contextlib
    import io
    df = QUERIES["star_enrich_rename"](scale_spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "SortMergeJoin" in buf.getvalue() and "BroadcastHashJoin" not in buf.getvalue()
