"""User aggregates with their own merge, and co-grouped streams, against plain Python."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.operators import merging as M
from quarry.streaming.cogroup import cogroup_streams


def _rows(n=500, seed=3):
    rng = random.Random(seed)
    return [(rng.choice(["a", "a", "a", "b", None, "c"]), rng.choice([None, 1, 2, 5, 5, 9]), rng.choice(["x", "y", None]), i) for i in range(n)]


def _top(rows, k):
    best = sorted((r for r in rows if r[1] is not None), key=lambda r: (-r[1], (r[2] is not None, r[2] or ""), r[3]))[:k]
    return [f"{r[1]}|{r[2] or ''}|{r[3]}" for r in best]


@pytest.mark.parametrize("depth", [1, 2, 3])
@pytest.mark.parametrize("held", [1, 20_000])
def test_top_k_equals_a_sort(spark, depth, held):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, v int, t string, i int").repartition(23)
    got = M.merge_aggregate(df, ["g"], M.TopK(7, "v", "t", "i"), "top", depth=depth, fan_in=4, held=held)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    assert {r.g: r.top for r in got.collect()} == {g: _top(rs, 7) for g, rs in by.items()}
    (whole,) = M.merge_aggregate(df, [], M.TopK(7, "v", "t", "i"), "top", depth=depth, fan_in=4).collect()
    assert whole.top == _top(rows, 7)


def test_empty_nan_keys_and_arguments(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("nan"), 2), (None, 3)], "g double, v int").repartition(3)
    got = M.merge_aggregate(df, ["g"], M.TopK(5, "v"), "top").collect()
    assert sorted((str(r.g), r.top) for r in got) == [("None", ["3"]), ("nan", ["2", "1"])]
    assert M.merge_aggregate(df.limit(0), ["g"], M.TopK(5, "v"), "top").count() == 0
    assert [r.top for r in M.merge_aggregate(df.limit(0), [], M.TopK(5, "v"), "top").collect()] == [[]]
    with pytest.raises(ValueError):
        M.merge_aggregate(df, ["g"], M.TopK(5, "v"), "top", depth=0)


def test_reservoir_is_the_same_in_any_layout_and_follows_weights(spark):
    df = spark.range(2000).select(F.lit("g").alias("g"), "id", F.when(F.col("id") % 2 == 0, 9.0).otherwise(1.0).alias("w"),
                                  (F.col("id") % 2).cast("string").alias("v"))
    picks = []
    for seed in range(5):
        agg = M.WeightedReservoir(100, "v", "w", "id", seed)
        samples = {tuple(M.merge_aggregate(df.repartition(n), ["g"], agg, "s", depth=d).first().s) for n, d in ((1, 1), (7, 2))}
        assert len(samples) == 1 and len(next(iter(samples))) == 100
        picks += next(iter(samples))
    assert abs(picks.count("0") / len(picks) - 0.9) < 0.05
    agg = M.WeightedReservoir(3, "v", "w", "id")
    assert M.merge_aggregate(df.withColumn("w", F.lit(0.0)), ["g"], agg, "s").first().s == []


class Mean(M.MergeAggregate):
    """Count and mean, merged as a pair: neither a sum nor an extreme."""
    inputs = ("v",)

    def zero(self):
        return 0, 0.0

    def update(self, state, rows):
        for v in rows.column("v").to_pylist():
            if v is not None:
                state = self.merge(state, (1, float(v)))
        return state

    def merge(self, left, right):
        n = left[0] + right[0]
        return (n, left[1] + (right[1] - left[1]) * right[0] / n) if n else left

    def finish(self, state):
        return state[1] if state[0] else None


def test_own_state(spark):
    df = spark.createDataFrame(_rows(), "g string, v int, t string, i int").repartition(9)
    want = {r.g: r.m for r in df.groupBy("g").agg(F.avg("v").alias("m")).collect()}
    got = {r.g: r.m for r in M.merge_aggregate(df, ["g"], Mean(), "m", depth=3, fan_in=2).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[g], want[g]) for g in want)


def _listed(key, left, right):
    yield (*key, [r["x"] for r in left], [r["y"] for r in right])


def test_cogroup_hands_over_both_streams_in_order(spark):
    rng = random.Random(1)
    a = [(rng.choice(["k", "k", "m", None, "left"]), rng.randint(0, 99)) for _ in range(300)]
    b = [(rng.choice(["k", "m", None, "right"]), rng.randint(0, 99), "z") for _ in range(200)]
    left, right = spark.createDataFrame(a, "key string, x int").repartition(4), spark.createDataFrame(b, "key string, y int, z string")
    got = cogroup_streams(left, right, ["key"], _listed, "key string, xs array<int>, ys array<int>", ["x"], [-F.col("y")])
    keys = {r[0] for r in a} | {r[0] for r in b}
    want = {k: (sorted(x for q, x in a if q == k), sorted((y for q, y, _ in b if q == k), reverse=True)) for k in keys}
    assert {r.key: (r.xs, r.ys) for r in got.collect()} == want


def test_cogroup_streams_may_be_left_unread(spark):
    left, right = spark.range(1000).select((F.col("id") % 3).alias("k"), "id"), spark.range(500).select((F.col("id") % 4).alias("k"), "id")

    def only_right(key, lefts, rights):
        yield (key[0], sum(1 for _ in rights))

    def first_left(key, lefts, rights):
        row = next(lefts, None)
        yield (key[0], None if row is None else row["id"])
    schema = "k long, n long"
    assert {r.k: r.n for r in cogroup_streams(left, right, ["k"], only_right, schema).collect()} == {k: 125 for k in range(4)}
    got = cogroup_streams(left, right, ["k"], first_left, schema, ["id"], ["id"])
    assert {r.k: r.n for r in got.collect()} == {0: 0, 1: 1, 2: 2, 3: None}
    assert cogroup_streams(left.limit(0), right.limit(0), ["k"], first_left, schema).count() == 0
