"""Joins of keys heavy on both sides, and quantiles by sketches and by selection, against plain forms."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import heavy as H
from quarry.operators import sketches as Q


def _side(spark, name, n, seed):
    """A third of the rows holds key 7, some have none."""
    return spark.range(n).selectExpr(f"CASE WHEN id % 3 = 0 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE CAST(pmod(xxhash64(id, {seed}), 500) AS INT) END AS k",
                                     f"id AS {name}", f"map(1, 2) AS m{name}")


@pytest.mark.parametrize("cells", [1, 4, 40])
def test_grid_join_equals_a_plain_join(spark, cells):
    a, b = _side(spark, "x", 900, 1), _side(spark, "y", 600, 2)
    pairs = lambda d: sorted((r.k, r.x, r.y) for r in d.select("k", "x", "y").collect())
    got = pairs(H.grid_join(a, b, "k", cells))
    assert got == pairs(a.join(b, "k")) and len(got) > 60_000


def test_hot_key_is_found_and_spread_on_both_sides(spark):
    a, b = _side(spark, "x", 30_000, 1), _side(spark, "y", 20_000, 2)
    (hot,) = H.heavy_keys(a, ["k"], 30).collect()
    assert hot.lines >= 10 and abs(hot.n - 10_000) < 300
    left, right = H.grid_sides(a, b, ["k"], 30)
    for side, own, n in ((left, "_g_row", 30_000), (right, "_g_col", 20_000)):
        assert side.groupBy("k", "_g_row", "_g_col").count().agg(F.max("count")).first()[0] < 1.5 * n / 30
        assert side.where("k = 7").select(own).distinct().count() >= 10
    plan = H.grid_join(a, b, "k", 30)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_rows_no_keys_other_types_and_equal_rows(spark):
    a, b = _side(spark, "x", 90, 1), _side(spark, "y", 60, 2)
    assert H.grid_join(a.where("false"), b, "k", 8).count() == 0
    assert H.grid_join(a.withColumn("k", F.lit(None).cast("int")), b, "k", 8).count() == 0
    with pytest.raises(TypeError):
        H.grid_join(a, b.withColumn("k", F.col("k").cast("long")), "k", 8)
    same = spark.range(50).select(F.lit("a").alias("k"), F.lit(float("nan")).alias("j"))
    assert H.grid_join(same, same, ["k", "j"], 8).count() == 2500


def test_job_free_build(spark):
    a, b = _side(spark, "x", 90, 1), _side(spark, "y", 60, 2)
    group = "grid-build"
    spark.sparkContext.setJobGroup(group, group)
    try:
        H.grid_join(a, b, "k", 8)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sketches_merge_to_the_total(spark):
    df = spark.range(50_000).select((F.col("id") % 5).alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    total = Q.merge_sketches(Q.quantile_sketches(df, ["g"], "v"), [], "bigint")
    values = np.sort([r.v for r in df.select("v").collect()])
    for p in (0.0, 0.01, 0.5, 0.99, 1.0):
        q = total.select(Q.sketch_quantile("sketch", "bigint", p).alias("q")).first().q
        assert abs(np.searchsorted(values, q) / len(values) - p) < 0.02


PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def _percentile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo, hi = values[math.floor(at)], values[math.ceil(at)]
    return float(lo) if lo == hi else (1 - (at - math.floor(at))) * lo + (at - math.floor(at)) * hi


@pytest.mark.parametrize("margin", [0.02, 0.0])
def test_exact_quantiles_equal_a_sort(spark, margin):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice([None, rng.randrange(9), rng.randrange(10**6)])) for _ in range(3000)]
    rows += [("one", 4), ("none", None), ("two", -3), ("two", 8)]
    df = spark.createDataFrame(rows, "g string, v long").repartition(7)
    got = {r.g: r.q for r in Q.exact_quantiles(df, ["g"], "v", PROBS, "q", margin=margin, k=16 if margin == 0.0 else Q.K).collect()}
    want = {g: [_percentile([v for k, v in rows if k == g and v is not None], p) for p in PROBS] for g in ("a", "b", None, "one", "two")}
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)


def test_exact_quantiles_of_doubles_without_groups_and_without_rows(spark):
    df = spark.createDataFrame([(x,) for x in (1.5, float("nan"), None, -2.0, 1.5, 9.0)], "v double")
    assert Q.exact_quantiles(df, [], "v", [0.5, 1.0], "q").first().q == [1.5, 9.0]
    assert Q.exact_quantiles(df.where("false"), [], "v", [0.5], "q").count() == 0
    with pytest.raises(TypeError):
        Q.exact_quantiles(df.select(F.lit("x").alias("v")), [], "v", [0.5])
