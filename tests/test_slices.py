"""Segmented scans against plain windows, on hot keys, ties, nulls and any number of slices."""

import datetime as dt
import random

import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import slices as S

T0 = dt.datetime(2024, 1, 1)


def _sorted(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def _rows(n=600, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([7, 7, 7, 7, 1, 2, None, 3, 4]), rng.choice([None, 1, 2, 3, 5, 5, 5, 40]), rng.choice([None, -3, 10, 10**12]), i) for i in range(n)]


@pytest.mark.parametrize("slices", [1, 3, 16, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_running_equals_the_window(spark, slices, descending):
    df = spark.createDataFrame(_rows(), "k int, o int, v long, i int")
    order = [F.desc("o") if descending else F.asc("o"), "i"]
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long").alias("p"),
                     F.sum("v").over(w).alias("s"), F.max("o").over(w).alias("m"))
    got = S.running(df, ["k"], order, [("count", None, "p"), ("sum", "v", "s"), ("max", "o", "m")], slices)
    assert got.schema == want.schema or [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert _sorted(got) == _sorted(want)


def test_running_of_doubles_and_small_integers(spark):
    df = spark.createDataFrame([(1, i, x, i) for i, x in enumerate([0.5, None, 2.25, -1.0] * 30)], "k int, o int, x double, b int") \
        .withColumn("b", F.col("b").cast("tinyint"))
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    got = S.running(df, ["k"], ["o"], [("sum", "x", "s"), ("max", "x", "m"), ("max", "b", "t")], 7)
    assert got.schema["t"].dataType.simpleString() == "tinyint"
    assert _sorted(got) == _sorted(df.select("*", F.sum("x").over(w), F.max("x").over(w), F.max("b").over(w)))
    with pytest.raises(TypeError):
        S.running(df.withColumn("d", F.lit("x")), ["k"], ["o"], [("sum", "d", "s")])


def test_no_keys_nan_keys_and_empty(spark):
    df = spark.createDataFrame([(float("nan"), i) for i in range(50)] + [(None, i) for i in range(50)], "k double, i int")
    got = S.running(df, ["k"], ["i"], [("count", None, "p")], 9)
    assert sorted((str(r.k), r.i, r.p) for r in got.collect()) == sorted((k, i, i + 1) for k in ("nan", "None") for i in range(50))
    assert sorted(r.p for r in S.running(df, [], ["i"], [("count", None, "p")], 9).collect()) == list(range(1, 101))
    assert S.running(df.limit(0), ["k"], ["i"], [("count", None, "p")]).count() == 0


def test_hot_key_and_its_ties_are_shared_out(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.lit(5).alias("o"), "id")
    cut = S.ordered_slices(df, ["k"], ["o"], 8)
    sizes = [r["count"] for r in cut.groupBy("_r_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20_000 / 8
    assert cut.select(F.spark_partition_id().alias("p"), "_r_slice").distinct().count() == 8
    assert sorted(r.p for r in S.running(df, ["k"], ["o"], [("count", None, "p")], 8).collect()) == list(range(1, 20_001))


def test_carried_states_are_one_row_a_slice(spark):
    df = spark.range(5000).select((F.col("id") % 1000).alias("k"), "id")
    scan = S.Running([("count", None, "p")], df.schema)
    cut = S.ordered_slices(df, ["k"], ["id"], 6)
    assert cut.mapInArrow(lambda it: S._edges(it, ["k"], scan), "number int, edge binary").count() == 6


@pytest.mark.parametrize("slices", [1, 5, 40])
def test_gap_cut_equals_the_window(spark, slices):
    rng, rows = random.Random(4), []
    for k in (1, 1, 1, 1, 2, None):
        at = T0
        for _ in range(150):
            at += dt.timedelta(seconds=rng.choice([1, 5, 60, 61, 600]))
            rows.append((k, at))
    rows += [(1, None), (1, None), (3, None)]
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz")
    by = Window.partitionBy("k").orderBy("ts")
    gap = F.coalesce((F.col("ts") - F.lag("ts").over(by)) > F.expr("INTERVAL 60 SECONDS"), F.lit(False)).cast("int")
    want = df.withColumn("c", gap).select("k", "ts", (F.sum("c").over(by) + 1).alias("stretch"))
    assert _sorted(S.segmented_scan(df, ["k"], ["ts"], S.GapCut("ts", 60_000_000), slices)) == _sorted(want)


class Longest(S.Scan):
    """A user's own state: the longest word so far, the first among equals."""
    columns = [("longest", "string")]

    def summarise(self, rows):
        return max((w for w in rows.column("w").to_pylist() if w is not None), key=len, default="")

    def combine(self, left, right):
        return max(left, right, key=len)

    def apply(self, rows, starts, before):
        out, now = [], before or ""
        for k, w in enumerate(rows.column("w").to_pylist()):
            now = max("" if starts[k] and k else now, w or "", key=len)
            out.append(now)
        return [pa.array(out, pa.string())]


@pytest.mark.parametrize("slices", [1, 4, 30])
def test_user_state(spark, slices):
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2]), i, rng.choice(["a", "bb", "cc", None, "ddd" + "e" * rng.randint(0, 9)])) for i in range(300)]
    got = S.segmented_scan(spark.createDataFrame(rows, "k int, i int, w string"), ["k"], ["i"], Longest(), slices)
    want, now = [], {}
    for k, i, w in sorted(rows, key=lambda r: r[:2]):
        now[k] = max(now.get(k, ""), w or "", key=len)
        want.append((k, i, w, now[k]))
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == want


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("frame", [(-3, 0), (0, 2), (-2, 4), (1, 3), (-5, -1)])
def test_range_frames_equal_the_window(spark, descending, frame):
    df = spark.createDataFrame(_rows(300), "k int, o int, v long, i int")
    o = F.desc("o") if descending else F.asc("o")
    want = df.withColumn("range_sum", F.sum("v").over(Window.partitionBy("k").orderBy(o).rangeBetween(*frame)))
    assert _sorted(S.range_frame_sum(df, ["k"], "o", "v", *frame, descending=descending, slices=5)) == _sorted(want)


def test_range_frame_of_distinct_values_is_spread(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.lit(1).alias("v"))
    got = S.range_frame_sum(df, ["k"], "o", "v", -9, 0, slices=8)
    assert got.where("range_sum <> least(o + 1, 10)").count() == 0 and got.count() == 4000
    with pytest.raises(TypeError):
        S.range_frame_sum(df.withColumn("v", F.lit(0.5)), ["k"], "o", "v", 0, 1)
