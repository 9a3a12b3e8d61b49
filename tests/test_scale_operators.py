"""Sketches, selection, runs and positions against plain versions, on skewed and odd values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from civicstat.operators import runs, selection, sketch
from civicstat.operators.position import with_position


def test_sketches_merge_to_the_same_estimate_and_stay_within_the_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 21_001).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("b"))
    parts = sketch.sketch_rows(df.withColumn("p", F.col("a") % 4), ["g", "p"], {"a": F.col("a"), "b": F.col("b")}, value="b", by_file=False)
    merged = {r.g: r for r in sketch.estimates(sketch.merge_sketches(parts, ["g"], total="all")).collect()}
    exact = {r.g: r for r in df.groupingSets([["g"], []], "g").agg(F.count_distinct("a").alias("a"), F.count_distinct("b").alias("b"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("b").isNull()).alias("nulls")).collect()}
    assert set(merged) == {0, 1, 2, None} == set(exact) and merged[None].all
    for g, r in merged.items():
        assert abs(r.a - exact[g].a) <= sketch.bound() * exact[g].a and r.b == exact[g].b == 5
        assert (r.row_count, r.null_values) == (exact[g].n, exact[g].nulls)
    whole = sketch.estimates(sketch.sketch_rows(df, ["g"], {"a": F.col("a")}, by_file=False)).collect()
    assert all(abs(r.a - merged[r.g].a) <= 2 * sketch.bound() * r.a for r in whole)


def test_sketches_of_files_and_density(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(400).select((F.col("id") % 2).alias("g"), (F.col("id") % 10).alias("x"), (F.col("id") % 8).alias("y"))
    df.repartition(4).write.parquet(path)
    rows = sketch.sketch_rows(spark.read.parquet(path), ["g"], {"x": F.col("x"), "y": F.col("y")})
    assert rows.select("file").distinct().count() == 4 and rows.count() == 8
    d = {r.g: r for r in sketch.density(sketch.merge_sketches(rows, ["g"]), ["x", "y"]).collect()}
    assert d[0].expected_cells == 20.0 and d[0].density == 10.0
    empty = sketch.merge_sketches(sketch.sketch_rows(df.where("g > 5"), ["g"], {"x": F.col("x")}, by_file=False), ["g"])
    assert sketch.estimates(empty).count() == 0


@pytest.mark.parametrize("values", [
    [3.0], [1.0, 2.0], [5.0] * 100 + [1.0], [1e-300, -1e300, 1e300, 0.0, -0.0, 5e-324], [float(i * i % 97) for i in range(1000)],
    [1.0 + i * 2.0 ** -52 for i in range(50)], [1.7e308, -1.7e308, 0.0], [math.inf, -math.inf, 1.0, 2.0, 3.0], [None, 4.0, None, 6.0]])
def test_selection_against_a_sort(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    order = sorted(v for v in values if v is not None)
    for buckets in (2, 4096):
        got = selection.order_statistics(df, "v", range(0, len(order), max(1, len(order) // 7)), buckets) if len(order) < 100 else selection.order_statistics(df, "v", None, buckets)
        assert all(order[r] == x for r, x in got.items()) and got
    middle = order[(len(order) - 1) // 2], order[len(order) // 2]
    assert selection.exact_median(df, "v") == pytest.approx(middle[0] if middle[0] == middle[1] else middle[0] + (middle[1] - middle[0]) / 2)


def test_selection_of_nothing_nan_and_bad_ranks(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    assert selection.exact_median(df, "v") is None
    assert [r.above_median for r in selection.above_exact_median(df, "v").collect()] == [None, None]
    with pytest.raises(IndexError):
        selection.order_statistics(df, "v", [0])
    nan = spark.createDataFrame([(math.nan,), (1.0,), (math.inf,)], "v double")
    got = selection.order_statistics(nan, "v", [0, 1, 2])
    assert got[0] == 1.0 and got[1] == math.inf and math.isnan(got[2])


def test_runs_against_a_plain_loop(spark):
    rng = random.Random(5)
    rows = [(f"s{k}", p) for k in range(30) for p in range(1990, 2010) if rng.random() < 0.5 for _ in range(rng.randrange(1, 3))] + [("s1", None)]
    df = spark.createDataFrame(rows, "s string, p int").repartition(4)
    names = [f"s{k}" for k in range(31)]
    want, islands = [], []
    for s in names:
        have = sorted({p for n, p in rows if n == s and p is not None})
        lo, hi = min(p for _, p in rows if p), max(p for _, p in rows if p)
        absent = [p for p in range(lo, hi + 1) if p not in have]
        for ps, out in ((absent, want), (have, islands)):
            while ps:
                n = next((i for i in range(1, len(ps)) if ps[i] != ps[i - 1] + 1), len(ps))
                place = "whole" if not have else "leading" if ps[n - 1] < have[0] else "trailing" if ps[0] > have[-1] else "inner"
                out.append((s, place, ps[0], ps[n - 1], n) if out is want else (s, ps[0], ps[n - 1], n))
                ps = ps[n:]
    series = spark.createDataFrame([(n,) for n in names], "s string")
    assert sorted(map(tuple, runs.absent_runs(df, ["s"], F.col("p"), series=series).collect())) == sorted(want)
    assert sorted(map(tuple, runs.present_runs(df, ["s"], F.col("p")).collect())) == sorted(islands)
    text = {r.t for r in runs.absent_runs(df, ["s"], F.col("p"), 2000, 2001).select(runs.range_text().alias("t")).collect()}
    assert text <= {"2000", "2001", "2000 to 2001"} and text


def test_positions_of_skewed_keys_ties_and_nothing(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.when(F.col("id") % 11 > 0, F.col("id")).alias("v"), "id")
    order = [F.col("k").asc(), F.col("v").desc_nulls_last(), F.col("id").asc()]
    got = sorted(with_position(df, order).collect(), key=lambda r: r.position)
    want = sorted(df.collect(), key=lambda r: (r.k, r.v is None, -(r.v or 0), r.id))
    assert [r.id for r in got] == [r.id for r in want] and [r.position for r in got] == list(range(1, 5001))
    same = with_position(df.select(F.lit(1).alias("x")), [F.col("x").asc()])
    assert sorted(r.position for r in same.collect()) == list(range(1, 5001))
    assert with_position(df.where("id < 0"), order).columns == ["k", "v", "id", "position"]
    plan = with_position(df, order)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
