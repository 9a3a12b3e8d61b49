"""Hot keys: one key holds a third of all rows; results equal brute force."""

import random

import pytest
from pyspark.sql import functions as F

from civicstat.operators import rank, reshape as R, star
from tests.conftest import rows

N = 6000


@pytest.fixture(scope="module")
def events(spark):
    rnd = random.Random(7)
    data = []
    for i in range(N):
        user = 0 if i % 3 == 0 else rnd.randint(1, 200)          # user 0: a third of all rows
        data.append((i, user, rnd.randint(0, 50), rnd.choice("abcde"), float(rnd.randint(1, 100))))
    return data, spark.createDataFrame(data, "event_id long, user_id long, ts long, kind string, value double") \
        .repartition(16)


def test_latest_per_group_hot_key(events):
    data, df = events
    best = {}
    for e, u, ts, k, v in data:
        if u not in best or (ts, e) > best[u][:2]:
            best[u] = (ts, e, k, v)
    got = {r.user_id: (r.ts, r.event_id, r.kind, r.value)
           for r in rank.latest_per_group(df, "user_id", "ts", ["kind", "value"], tiebreak=["event_id"]).collect()}
    assert got == best


def test_top_k_and_semi_join_hot_key(events):
    data, df = events
    totals = {}
    for _, u, _, _, v in data:
        totals[u] = totals.get(u, 0.0) + v
    expect = [u for u, _ in sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))[:3]]
    assert [r.user_id for r in rank.top_k(df, "user_id", "value", 3).collect()] == expect
    kept = rank.keep_top_k(df, "user_id", "value", 3)
    assert kept.count() == sum(1 for d in data if d[1] in expect)


def test_orphans_and_group_count_hot_key(spark, events):
    data, df = events
    dim = spark.createDataFrame([(u,) for u in range(1, 150)], "user_id long")
    expect = sum(1 for d in data if not (1 <= d[1] < 150))
    assert star.orphans(df, dim, "user_id").count() == expect
    counts = {r.user_id: r.rows for r in star.group_count(df, "user_id").collect()}
    assert counts[0] == N // 3


def test_pivot_and_stack_hot_key(events):
    data, df = events
    wide = R.pivot_agg(df, "user_id", "kind", F.count(F.lit(1)), list("abcde"), fill=0)
    r0 = wide.filter("user_id = 0").first()
    assert sum(r0[k] for k in "abcde") == N // 3
    cells = df.groupBy("user_id", "kind").agg(F.sum("value").alias("v"))
    got = {(r.user_id, r.kind): r.offset for r in R.stack_offsets(cells, "user_id", "kind", "v").collect()
           if r.user_id == 0}
    sums = {}
    for _, u, _, k, v in data:
        if u == 0:
            sums[k] = sums.get(k, 0.0) + v
    running, expect = 0.0, {}
    for k in sorted(sums):
        expect[(0, k)] = running
        running += sums[k]
    assert got == expect
