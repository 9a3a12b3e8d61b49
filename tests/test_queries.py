"""Every registered query against its DuckDB oracle (sf0.001), plus the entry point."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from civicstat.plans.registry import all_queries
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES = {name: q.build for name, q in all_queries().items()}
ORACLE = {name: q.sql for name, q in all_queries().items() if q.sql}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 6)
    return v


def canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["table_name", "community", "rows"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


SPARK_TO_DUCK = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "DateType": "DATE", "TimestampNTZType": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    dtypes = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    stypes = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__) for f in sdf.schema.fields}
    assert stypes == dtypes
    res = con.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert canon(scols, srows) == canon(dcols, drows)
