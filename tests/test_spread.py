"""Ordered operators on hot keys, nulls and extreme values; nothing runs while a plan is built."""

import datetime as dt

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import sequence as Q
from quarry.operators import trajectory as TR
from quarry.operators import windows as W
from quarry.streaming import keyed_stream as KS

T0 = dt.datetime(2024, 1, 1)
BIG = 2 ** 53


def _sorted(df):
    """Rows as text, so that NaN equals NaN."""
    return sorted(repr(tuple(r)) for r in df.collect())


def test_previous_row_across_a_null_bucket(spark):
    df = spark.createDataFrame([(1, None, 10), (1, 5, 20), (1, 6, None), (1, 90, 30)], "k int, v int, x int")
    want = df.withColumn("prev_x", F.lag("x").over(Window.partitionBy("k").orderBy("v")))
    assert _sorted(Q.ordered_previous(df, ["k"], "v", Q.value_bucket("v", 4), ["x"])) == _sorted(want)


@pytest.mark.parametrize("kind,values", [
    ("double", [3.0, float("nan"), None, float("inf"), -0.5, float("nan"), float("-inf")]),
    ("int", [-2 ** 31, 2 ** 31 - 1, None, 0, 5, -2 ** 31]), ("long", [-2 ** 63, 2 ** 63 - 1, None, 1])])
def test_descending_buckets_place_nan_and_extremes_as_the_sort_does(spark, kind, values):
    df = spark.createDataFrame([(1, v, i) for i, v in enumerate(values)], f"k int, v {kind}, i int")
    order = [F.desc("v"), "i"]
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    got = W.row_numbers(df, ["k"], order, W.desc_bucket("v", "i"), "p", descending=True)
    assert _sorted(got) == _sorted(want)


def test_strict_check_fails_under_count_too(spark):
    rows = [(1, T0, 0), (1, T0 - dt.timedelta(minutes=1), 1), (None, T0, 2)]
    bad = TR.order_violations(spark.createDataFrame(rows, "mmsi int, ts timestamp_ntz, seq long"), strict=True)
    for action in (bad.count, bad.collect):
        with pytest.raises(Exception, match="unsorted data"):
            action()


def test_long_keys_beside_null_stay_apart(spark):
    rows = [(k, T0 + dt.timedelta(seconds=i)) for k in (None, BIG, BIG + 1) for i in range(3)]
    df = spark.createDataFrame(rows, "mmsi long, ts timestamp_ntz")
    want = _sorted(TR.build_trajectories_window(df, size=2))
    assert len(want) == 6
    for build in (TR.build_trajectories, KS.trajectories_grouped, KS.trajectories_partition_iterator):
        assert _sorted(build(df, size=2)) == want, build.__name__
    one = KS.trajectories_partition_iterator(df, size=2, num_partitions=1)
    assert _sorted(one) == want


def _hot(spark):
    """One vessel with a third of the rows, all in one hour; many small vessels."""
    hot = spark.range(20_000).select(F.lit(7).alias("mmsi"), (F.col("id") * 170).alias("ms"))
    small = spark.range(40_000).select((F.col("id") % 4000 + 100).cast("int").alias("mmsi"), (F.col("id") * 80_000).alias("ms"))
    return hot.union(small).select("mmsi", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, ms / 1000)").alias("ts"))


def test_a_dense_hour_is_spread(spark):
    df = _hot(spark)
    per_group = (df.withColumn("b", Q.time_bucket("ts")).groupBy("mmsi", "b").count().agg(F.max("count")).first()[0])
    assert per_group < 20_000 / 40          # the groups that tasks get whole
    got = TR.build_trajectories(df, size=500)
    assert _sorted(got) == _sorted(TR.build_trajectories_window(df, size=500))


def test_no_job_runs_while_plans_are_built(spark):
    df = _hot(spark)
    tracker, group = spark.sparkContext.statusTracker(), "building"
    spark.sparkContext.setJobGroup(group, "plans are built, nothing runs")
    TR.build_trajectories(df)
    TR.time_diffs(df)
    KS.trajectories_grouped(df)
    KS.trajectories_partition_iterator(df)
    r = df.withColumn("q", F.col("mmsi") % 7)
    W.running_totals(r, ["mmsi"], [F.desc("q")], W.desc_bucket("q", spread=4), "q", descending=True)
    W.row_numbers(r, ["mmsi"], [F.desc("q")], W.desc_bucket("q", spread=4), descending=True)
    W.ranks_spread(r, ["mmsi"], "q", W.desc_bucket("q"), descending=True)
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setJobGroup("rest", "")


def test_state_is_carried_over_batches_and_keys(spark):
    """Gaps above a limit, by a function that remembers the last record: the same for a key in one batch or in many."""
    rows = [(k, T0 + dt.timedelta(seconds=s)) for k, n in ((1, 500), (None, 40), (2, 1), (BIG, 7), (BIG + 1, 7))
            for s in (i * i % 977 for i in range(n))]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz")
    lagged = F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(Window.partitionBy("k").orderBy("ts")))
    want = _sorted(df.withColumn("gap", lagged).where("gap > 5").select("k", "gap"))

    def step(last, rows):
        secs = pc.cast(rows.column("ts"), pa.int64()).to_numpy() // 1_000_000
        before = secs[:1] if last is None else [last]
        gaps = secs - [*before, *secs[:-1]]
        out = pa.table({"k": rows.column("k"), "gap": pa.array(gaps, pa.int64())})
        return int(secs[-1]), out.filter(pc.greater(out.column("gap"), 5))

    for batch in (7, 10_000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        try:
            assert _sorted(KS.fold_sorted_groups(df, ["k"], ["ts"], step, "k long, gap long", num_partitions=3)) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
