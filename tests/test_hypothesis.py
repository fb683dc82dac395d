"""Property tests: the split/bucketed forms equal Spark's own windows on random data."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import sequence as Q
from quarry.operators import windows as W

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),     # key, with nulls
                             st.one_of(st.none(), st.integers(0, 40)),    # order value, with nulls and ties
                             st.integers(-5, 5)),                         # value
                   min_size=1, max_size=60)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@SETTINGS
@given(rows=rows_st, width=st.integers(1, 15))
def test_position_and_lag_match_windows(spark, rows, width):
    df = spark.createDataFrame([(k, o, v, i) for i, (k, o, v) in enumerate(rows)], "k int, o int, v int, i int")
    order = ["o", "i"]                                  # total order so positions are determined
    w = Window.partitionBy("k").orderBy(*order)
    got = Q.ordered_position(df, ["k"], order, Q.value_bucket("o", width), "p")
    want = df.withColumn("p", F.row_number().over(w).cast("long"))
    assert _sorted(got.select("k", "o", "v", "i", "p")) == _sorted(want)
    got_lag = Q.ordered_previous(df.withColumn("oi", F.struct("o", "i")), ["k"], "oi",
                                 Q.value_bucket("o", width), ["v"])
    want_lag = df.withColumn("prev_v", F.lag("v").over(w))
    assert _sorted(got_lag.select("k", "o", "v", "i", "prev_v")) == _sorted(want_lag)


@SETTINGS
@given(rows=rows_st, spread=st.integers(0, 4))
def test_desc_running_totals_and_ranks_match_windows(spark, rows, spread):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    rw = W.running_window(["k"], [F.desc("o")])
    got = W.running_totals(df, ["k"], [F.desc("o")], W.desc_bucket("o", spread=spread), "o", "s", "m",
                           descending=True)
    want = df.select("k", "o", "v", F.sum("o").over(rw).alias("s"), F.max("o").over(rw).alias("m"))
    # ties make ROWS-frame values per row ambiguous, but not their multiset per (key, value)
    proj = lambda d: sorted(((r.k, r.o, r.s, r.m) for r in d.collect()), key=repr)
    assert proj(got) == proj(want)
    wr = Window.partitionBy("k").orderBy(F.desc_nulls_last("o"))
    want_r = df.select("k", "o", "v", F.rank().over(wr).alias("rank"), F.dense_rank().over(wr).alias("dense_rank"))
    got_r = W.ranks(df, ["k"], "o", descending=True).select("k", "o", "v", "rank", "dense_rank")
    assert _sorted(got_r) == _sorted(want_r)
    for bucket in (W.desc_bucket("o"), F.floor(F.col("o") / 4)):
        got_s = W.ranks_spread(df, ["k"], "o", bucket, descending=True).select("k", "o", "v", "rank", "dense_rank")
        assert _sorted(got_s) == _sorted(want_r)


@SETTINGS
@given(rows=rows_st, lo=st.integers(-6, 0), width=st.integers(0, 6), desc=st.booleans())
def test_range_frame_sum_matches_range_window(spark, rows, lo, width, desc):
    df = spark.createDataFrame(rows, "k int, o int, v int")
    hi = lo + width
    o = F.col("o").desc() if desc else F.col("o").asc()
    w = Window.partitionBy("k").orderBy(o).rangeBetween(lo, hi)
    want = df.select("k", "o", "v", F.sum("v").over(w).alias("s"))
    got = W.range_frame_sum(df, ["k"], "o", "v", lo, hi, descending=desc, name="s").select("k", "o", "v", "s")
    assert _sorted(got) == _sorted(want)


@SETTINGS
@given(rows=rows_st)
def test_value_counts_expand_to_collect_list(spark, rows):
    from quarry.operators import aggregates as A
    df = spark.createDataFrame(rows, "k int, o int, v int")
    rle = {r.k: (r["values"], r.counts) for r in A.value_counts(df, ["k"], "o").collect()}
    lists = {r.k: sorted(r.l) for r in df.groupBy("k").agg(F.collect_list("o").alias("l")).collect()}
    expanded = {k: [v for v, c in zip(vs, cs) for _ in range(c)] for k, (vs, cs) in rle.items()}
    assert expanded == {k: v for k, v in lists.items() if v}


@SETTINGS
@given(vals=st.lists(st.one_of(st.none(), st.integers(-20, 20)), min_size=1, max_size=80),
       buckets=st.integers(1, 9))
def test_row_position_is_a_sorted_numbering(spark, vals, buckets):
    from quarry.operators import joins as J
    df = spark.createDataFrame([(v, i) for i, v in enumerate(vals)], "v int, i int")
    got = J.with_row_position(df, ["v", "i"], buckets).collect()
    assert sorted(r.row_pos for r in got) == list(range(1, len(vals) + 1))
    by_pos = [(r.v, r.i) for r in sorted(got, key=lambda r: r.row_pos)]
    key = lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1])  # noqa: E731  nulls first
    assert by_pos == sorted(by_pos, key=key)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(events=st.lists(st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(0, 500))),
                       min_size=1, max_size=120),
       size=st.integers(1, 12))
def test_trajectory_variants_match_window_form(spark, events, size):
    import datetime as dt

    from quarry.operators import trajectory as TR
    from quarry.streaming import keyed_stream as KS
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, None if m is None else t0 + dt.timedelta(minutes=7 * m)) for k, m in events]
    df = spark.createDataFrame(rows, "mmsi int, ts timestamp_ntz")
    want = _sorted(TR.build_trajectories_window(df, size=size))
    assert _sorted(TR.build_trajectories(df, size=size, bucket_seconds=1800)) == want
    assert _sorted(KS.trajectories_grouped(df, size=size, bucket_seconds=1800, target_rows=7)) == want
    assert _sorted(KS.trajectories_partition_iterator(df, size=size, bucket_seconds=1800, target_rows=7,
                                                      num_partitions=3)) == want
