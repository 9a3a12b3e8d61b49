"""Bucketed copies: the orders x customer join of the IND build needs no shuffle."""

import contextlib
import io

from civicstat.plans.indicators import order_facts
from civicstat.sources.tables import load
from civicstat.sources.layout import bucketed_copy
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_join_has_no_exchange(spark):
    root = bucketed_copy(spark, SF_SMALL, "civic_bucketed", 4, keys={"customer": "c_custkey", "orders": "o_custkey"})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # force the shuffle-join path
    try:
        bucketed = plan(order_facts(spark, root))
        plain = plan(order_facts(spark, SF_SMALL))
        assert "SortMergeJoin" in bucketed and "Exchange" not in bucketed
        assert "SortMergeJoin" in plain and "Exchange hashpartitioning" in plain
        assert order_facts(spark, root).count() == order_facts(spark, SF_SMALL).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_appended_files_are_read(spark, tmp_path):
    path = str(tmp_path / "nation.parquet")
    spark.range(3).write.parquet(path)
    assert load(spark, str(tmp_path), "nation").count() == 3
    spark.range(5).write.mode("append").parquet(path)
    assert load(spark, str(tmp_path), "nation").count() == 8
