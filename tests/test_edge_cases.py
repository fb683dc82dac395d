"""Small inline tables for edge cases: chunk boundaries, hot keys, nulls, ties."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import scalars as S
from quarry.operators import aggregates as A
from quarry.operators import joins as J
from quarry.operators import keyvalue as KV
from quarry.operators import nulls as N
from quarry.operators import sequence as Q
from quarry.operators import trajectory as TR
from quarry.operators import udaf
from quarry.operators import windows as W
from quarry.sources import files
from quarry.sources.materialize import cached, checkpointed, schema_table
from quarry.streaming import keyed_stream as KS

POS = T.StructType([T.StructField("mmsi", T.IntegerType()), T.StructField("ts", T.TimestampNTZType())])
T0 = dt.datetime(2024, 1, 1)


def _positions(spark, counts, step_s=600):
    rows = [(k, T0 + dt.timedelta(seconds=i * step_s)) for k, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, POS)


def _expected(counts, size, step_s=600):
    out = []
    for k, n in counts.items():
        for c in range(0, n, size):
            m = min(size, n - c)
            out.append((k, T0 + dt.timedelta(seconds=c * step_s),
                        T0 + dt.timedelta(seconds=(c + m - 1) * step_s), m))
    return sorted(out)


@pytest.mark.parametrize("n", [9, 10, 11, 20, 1])
def test_chunk_boundaries(spark, n):
    counts = {1: n, 2: 3}
    df = _positions(spark, counts)
    for build in (TR.build_trajectories, KS.trajectories_grouped, KS.trajectories_partition_iterator,
                  TR.build_trajectories_window):
        got = sorted(tuple(r) for r in build(df, size=10).collect())
        assert got == _expected(counts, 10), build.__name__


def test_hot_vessel_spread_over_buckets(spark):
    # one vessel with most of the rows, spanning many hour buckets
    counts = {7: 3000, 8: 40, 9: 1}
    df = _positions(spark, counts, step_s=97)
    got = sorted(tuple(r) for r in TR.build_trajectories(df, size=500, bucket_seconds=600).collect())
    assert got == _expected(counts, 500, step_s=97)
    it = sorted(tuple(r) for r in KS.trajectories_partition_iterator(
        df, size=500, bucket_seconds=600, target_rows=700, num_partitions=3).collect())
    assert it == got
    gr = sorted(tuple(r) for r in KS.trajectories_grouped(df, size=500, bucket_seconds=600).collect())
    assert gr == got


def test_partition_iterator_carries_runs_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        counts = {1: 53, 2: 17, 3: 5}
        df = _positions(spark, counts, step_s=1)
        got = sorted(tuple(r) for r in KS.trajectories_partition_iterator(df, size=10, num_partitions=2).collect())
        assert got == _expected(counts, 10, step_s=1)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_ordered_position_equals_row_number_with_nulls(spark):
    rows = [(k, v) for k in (None, 1, 2) for v in range(30)] + [(1, None), (None, None)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = Q.ordered_position(df, ["k"], ["v"], Q.value_bucket("v", 7), "p")
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_ordered_position_descending_nulls_last(spark):
    rows = [(k, v) for k in (1, 2) for v in range(12)] + [(1, None), (2, None)]
    df = spark.createDataFrame(rows, "k int, v int")
    got = Q.ordered_position(df, ["k"], [F.desc("v")], -F.floor(F.col("v") / 5), "p", nulls_last=True)
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("v"))))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_ordered_previous_equals_lag(spark):
    rows = [(k, v, v * 10) for k in (1, 2) for v in range(25)]
    df = spark.createDataFrame(rows, "k int, v int, x int")
    got = Q.ordered_previous(df, ["k"], "v", Q.value_bucket("v", 4), ["x"])
    want = df.withColumn("prev_x", F.lag("x").over(Window.partitionBy("k").orderBy("v")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_order_violation_detected(spark):
    rows = [(1, T0, 0), (1, T0 + dt.timedelta(minutes=5), 1), (1, T0 + dt.timedelta(minutes=2), 2), (2, T0, 3)]
    df = spark.createDataFrame(rows, "mmsi int, ts timestamp_ntz, seq long")
    bad = TR.order_violations(df).collect()
    assert len(bad) == 1 and bad[0].seq == 2 and bad[0].gap_ms == -180_000
    with pytest.raises(Exception):
        TR.order_violations(df, strict=True).collect()


def test_ranks_and_range_frame_match_builtin_windows(spark):
    rows = [(d, q) for d in (1, 2) for q in (5, 5, 4, 1, 9, 9, 9, 2)] + [(3, None), (3, 1)]
    df = spark.createDataFrame(rows, "d int, q int")
    w = Window.partitionBy("d").orderBy(F.desc_nulls_last("q"))
    want = df.select("d", "q", F.rank().over(w).alias("rank"), F.dense_rank().over(w).alias("dense_rank"))
    got = W.ranks(df, ["d"], "q", descending=True).select("d", "q", "rank", "dense_rank")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    wr = Window.partitionBy("d").orderBy(F.desc("q")).rangeBetween(-3, 0)
    want2 = df.select("d", "q", F.sum("q").over(wr).alias("s"))
    got2 = W.range_frame_sum(df, ["d"], "q", "q", -3, 0, descending=True, name="s").select("d", "q", "s")
    assert sorted(map(tuple, got2.collect()), key=str) == sorted(map(tuple, want2.collect()), key=str)


def test_running_totals_match_builtin(spark):
    rows = [(c, q) for c in (1, 2, None) for q in (3, 1, 4, 1, 5, 9, 2, 6)] + [(1, None)]
    df = spark.createDataFrame(rows, "c int, q int")
    w = W.running_window(["c"], [F.desc("q")])
    want = df.select("c", "q", F.sum("q").over(w).alias("s"), F.max("q").over(w).alias("m"))
    got = W.running_totals(df, ["c"], [F.desc("q")], -F.col("q"), "q", "s", "m", nulls_last=True).select(
        "c", "q", "s", "m")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_user_mean_skips_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 3), ("b", None)], "g string, v int")
    got = {r.g: r.mean for r in udaf.aggregate(df, ["g"], udaf.mean_of("v")).collect()}
    assert got == {"a": 2.0, "b": None}
    total = udaf.aggregate(df, [], udaf.mean_of("v")).first()[0]
    assert total == 2.0


def test_fold_by_key_zero_and_user_aggregate(spark):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 5)], "key string, value int")
    assert {r.key: r.value for r in KV.fold_by_key(df, "max", 3.0).collect()} == {"x": 3.0, "y": 5.0}
    assert {r.key: r.value for r in KV.aggregate_by_key(df, "sum", 10.0).collect()} == {"x": 13.0, "y": 15.0}
    custom = KV.aggregate_by_key(df, udaf.fold_of("value", "sum"))
    assert {r.key: r.value for r in custom.collect()} == {"x": 3.0, "y": 5.0}


def test_value_counts_is_run_length_list(spark):
    df = spark.createDataFrame([("k", 2), ("k", 1), ("k", 2), ("j", None)], "key string, value int")
    got = {r.key: (r["values"], r.counts) for r in KV.combine_by_key_lists(df, 2).collect()}
    assert got == {"k": ([1, 2], [1, 2])}


def test_cogroup_missing_sides(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "k string, v int")
    b = spark.createDataFrame([("y", 9), ("z", 8)], "k string, v int")
    got = {r.k: (r.left_values, r.right_values) for r in J.cogroup_lists(a, b, "k", "v", "v").collect()}
    assert got == {"x": ([1, 2], []), "y": ([3], [9]), "z": ([], [8])}
    long_ = J.cogroup_long(a, b, "k", "v", "v", 2).collect()
    assert len(long_) == 5


def test_zip_requires_equal_length(spark):
    a = spark.range(10).withColumnRenamed("id", "a")
    b = spark.range(10).select((F.col("id") * 2).alias("b"))
    z = J.zip_positional(a, b, ["a"], ["b"], 3).collect()
    assert sorted((r.a, r.b) for r in z) == [(i, 2 * i) for i in range(10)]
    with pytest.raises(Exception):
        J.zip_positional(a, spark.range(9).withColumnRenamed("id", "b"), ["a"], ["b"], 3).collect()


def test_row_position_is_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("v"))
    got = J.with_row_position(df, ["v"], 5).orderBy("row_pos").collect()
    assert [r.row_pos for r in got] == list(range(1, 1001))
    assert [r.v for r in got] == list(range(1000))


def test_broadcast_lookup_leaves_the_form_to_spark(spark):
    words = spark.createDataFrame([("Spark",), ("Big",), ("Other",)], "word string")
    lookup = spark.createDataFrame([("Spark", 1000), ("Big", -300)], "word string, v int")
    got = {r.word: r.v for r in J.broadcast_lookup(words, lookup, "word", "v").collect()}
    assert got == {"Spark": 1000, "Big": -300, "Other": 0}
    plan = J.broadcast_lookup(words, lookup, "word", "v")._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_null_handling(spark):
    df = spark.createDataFrame([(None, None, 5.5), ("abcd", 3, None), ("ab", None, None)],
                               "code string, q int, p double")
    assert N.drop_rows(df, "any").count() == 0
    assert N.drop_rows(df, "all", ["q", "p"]).count() == 2
    filled = N.fill(df, 5.5).collect()
    assert [r.q for r in filled] == [5, 3, 5]
    codes = [r[0] for r in df.select(N.truncate_code("code")).collect()]
    assert codes == ["xxx", "abc(trunc)", "ab"]
    ts = N.fill_timestamp(spark.createDataFrame([(None,)], "t timestamp_ntz"), "t", "2020-01-01 00:00:00")
    assert ts.first()[0] == dt.datetime(2020, 1, 1)


def test_scalar_edges(spark):
    df = spark.createDataFrame([("RED ANVIL", -2, "32/13/2020 10:00:00", 2.25)], "d string, n int, t string, x double")
    r = df.select(S.element(F.split("d", " "), 5).alias("out_of_range"), S.zeros("n").alias("z"),
                  S.parse_timestamp("t", "dd/MM/yyyy HH:mm:ss").alias("bad"),
                  S.round_half_up("x", 1).alias("r"), S.round_half_up(-F.col("x"), 1).alias("rn"),
                  S.word_lengths("d")["MISSING"].alias("missing"), S.pad_left("d", 3).alias("cut")).first()
    assert r.out_of_range is None and r.z == [] and r.bad is None
    assert (r.r, r.rn) == (2.3, -2.3) and r.missing is None and r.cut == "RED"


def test_pair_aggregates_keep_repeated_columns(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "x")], "g string, q int, s string")
    r = A.pair_aggregates(df, ["g"], [("q", "count"), ("q", "min"), ("s", "collect_set")]).first()
    assert (r.count_q, r.min_q, r.collect_set_s) == (3, 1, ["x", "y"])


def test_files_roundtrip_and_rejects(spark):
    raw = spark.createDataFrame([(1, "01/02/2020 10:11:12", 1.5, 2.5), (2, "bad", 1.0, 1.0),
                                 (None, "01/02/2020 10:11:12", 1.0, 1.0)],
                                files.AIS_SCHEMA)
    good, rejects = files.ingest_positions(raw)
    assert [tuple(r) for r in good.collect()] == [(1, dt.datetime(2020, 2, 1, 10, 11, 12), 1.5, 2.5)]
    assert rejects.count() == 2
    path = files.write_csv(good, files.scratch_path(spark, "test"), header=True)
    back = files.read_csv(spark, path, "mmsi int, ts timestamp_ntz, lat double, lon double")
    assert back.collect() == good.collect()


def test_materialisation_helpers(spark):
    df = spark.range(100)
    with cached(df) as c:
        assert c.count() == 100 and c.is_cached
    assert not df.is_cached
    assert checkpointed(df).count() == 100
    st = {r.name: r.type for r in schema_table(spark, df).collect()}
    assert st == {"id": "bigint"}


def test_pipe_partitions_counts_lines(spark):
    from quarry.operators import partitioning as R
    df = spark.range(0, 50, 1, 4).select(F.col("id").cast("string").alias("w"))
    out = R.pipe_partitions(df, "w", ["wc", "-l"])
    assert out.count() == 4
    assert out.agg(F.sum(F.trim("line").cast("long"))).first()[0] == 50


def test_hot_key_isolation(spark):
    from quarry.operators import partitioning as R
    df = spark.createDataFrame([(17850 if i % 3 == 0 else i, i) for i in range(300)], "c int, i int")
    p = R.isolate_hot_key(df, "c", 17850, 2, ["i"]).withColumn("pid", F.spark_partition_id())
    hot = p.where("c = 17850").select("pid").distinct().collect()
    assert [r.pid for r in hot] == [0]
    q = R.isolate_hot_key(df, "c", 17850, 2, ["i"], n_hot=3).withColumn("pid", F.spark_partition_id())
    assert {r.pid for r in q.where("c = 17850").select("pid").distinct().collect()} == {0, 1, 2}
    assert {r.pid for r in q.where("c != 17850").select("pid").distinct().collect()} == {3, 4}
    assert {r.pid for r in p.where("c != 17850").select("pid").distinct().collect()} == {1, 2}


def test_row_position_text_key_with_nulls(spark):
    vals = [f"w{i:03d}" for i in range(200)] + [None, None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = J.with_row_position(df, ["v"], 6).collect()
    assert sorted(r.row_pos for r in got) == list(range(1, 203))
    by_pos = {r.row_pos: r.v for r in got}
    assert by_pos[1] is None and by_pos[2] is None          # nulls first, as in an ascending sort
    assert [by_pos[i] for i in range(3, 203)] == sorted(v for v in vals if v is not None)


def test_trajectory_variants_agree_with_null_times(spark):
    rows = [(1, T0 + dt.timedelta(minutes=i)) for i in range(23)] + [(1, None), (1, None), (2, None)]
    df = spark.createDataFrame(rows, POS)
    want = sorted(map(tuple, TR.build_trajectories_window(df, size=10).collect()), key=repr)
    for build in (TR.build_trajectories, KS.trajectories_grouped, KS.trajectories_partition_iterator):
        got = sorted(map(tuple, build(df, size=10).collect()), key=repr)
        assert got == want, build.__name__
    grouped = KS.map_sorted_slices(df, ["mmsi"], ["ts"], Q.time_bucket("ts"),
                                   lambda rows, off: rows.slice(0, 1).append_column("first", [[rows["ts"][0].as_py() is None]])
                                   .select(["mmsi", "first"]), "mmsi int, first boolean")
    assert {r.mmsi: r.first for r in grouped.collect()} == {1: True, 2: True}


def test_user_aggregate_combines_and_flushes_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(0, 5000, 1, 3).select(
            F.when(F.col("id") % 41 == 0, F.lit(None)).otherwise(F.col("id") % 37).alias("g"),
            F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("id") % 11).alias("v"))
        want = {r.g: r.a for r in df.groupBy("g").agg(F.avg("v").alias("a")).collect()}
        for rows in (5, 50, 10_000):
            got = {r.g: r.mean for r in udaf.aggregate(df, ["g"], udaf.mean_of("v"), combine_rows=rows).collect()}
            assert got.keys() == want.keys()
            assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_partition_iterator_null_times_and_keys(spark):
    rows = [(1, None), (1, None), (None, None), (None, T0), (None, T0 + dt.timedelta(minutes=1)), (2, T0)]
    df = spark.createDataFrame(rows, POS)
    want = sorted(map(tuple, TR.build_trajectories_window(df, size=1).collect()), key=repr)
    for build in (KS.trajectories_partition_iterator, KS.trajectories_grouped, TR.build_trajectories):
        assert sorted(map(tuple, build(df, size=1).collect()), key=repr) == want, build.__name__


def test_long_keys_beside_null_in_user_aggregates(spark):
    big = 2 ** 53
    df = spark.createDataFrame([(None, 1), (big, 1), (big + 1, 3), (big + 1, 3)], "k long, v int")
    got = {r.k: r.mean for r in udaf.aggregate(df, ["k"], udaf.mean_of("v")).collect()}
    assert got == {None: 1.0, big: 1.0, big + 1: 3.0}


def test_aggregate_by_key_keeps_the_type(spark):
    df = spark.createDataFrame([("a", 2 ** 53), ("a", 1), ("b", None)], "key string, value long")
    assert {r.key: r.value for r in KV.aggregate_by_key(df, "sum", 0).collect()} == {"a": 2 ** 53 + 1, "b": 0}
    assert {r.key: r.value for r in KV.aggregate_by_key(df, "sum").collect()} == {"a": 2 ** 53 + 1, "b": None}
    text = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "key string, value string")
    assert {r.key: r.value for r in KV.aggregate_by_key(text, "max", "").collect()} == {"a": "y", "b": ""}


def test_describe_covers_every_numeric_type(spark):
    df = spark.sql("SELECT cast(id AS tinyint) AS b, cast(id AS smallint) AS s, cast(id AS decimal(9, 2)) AS d, 'x' AS t FROM range(5)")
    got = {r.column: (r["count"], r["mean"], r["max"]) for r in A.describe_long(df).collect()}
    assert got == {c: (5, 2.0, 4.0) for c in ("b", "s", "d")}


def test_salted_join_equals_join(spark):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2, 3, None])], "k int, i int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (9, "d")], "k int, t string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert sorted(map(str, J.salted_join(left, right, "k", 4, how).collect())) == sorted(map(str, J.join(left, right, "k", how).collect()))


def test_pipe_failure_and_large_output(spark):
    from quarry.operators import partitioning as R
    df = spark.range(0, 30_000, 1, 2).select(F.col("id").cast("string").alias("w"))
    assert R.pipe_partitions(df, "w", ["cat"]).count() == 30_000
    with pytest.raises(Exception, match="exit code"):
        R.pipe_partitions(df, "w", ["false"]).count()
