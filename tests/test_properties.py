"""Property checks for plans whose values are random or depend on the layout."""

from pyspark.sql import functions as F

from quarry.operators import ordering as O
from quarry.operators import partitioning as R
from quarry.plans import PLANS
from quarry.sources.fixtures import flights, positions, retail
from quarry.sources.tables import read_table


def test_hash_sample_reproducible_and_layout_free(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    a = O.hash_sample(li, 0.1, ["l_orderkey", "l_linenumber"])
    b = O.hash_sample(li.repartition(7), 0.1, ["l_orderkey", "l_linenumber"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_split_disjoint_complete(spark, sf):
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    parts = O.hash_split(li, [0.25, 0.75], ["l_orderkey", "l_linenumber"])
    counts = [p.count() for p in parts]
    assert sum(counts) == li.count()
    assert parts[0].intersect(parts[1]).count() == 0


def test_sort_within_partitions_orders_each_partition(spark, sf):
    df = PLANS["sort_within_partitions"].fn(spark, sf).withColumn("pid", F.spark_partition_id())
    rows = df.select("pid", "cnt").collect()
    by_pid = {}
    for pid, cnt in rows:
        by_pid.setdefault(pid, []).append(cnt)
    assert all(v == sorted(v) for v in by_pid.values())


def test_secondary_sort_orders_globally(spark, sf):
    df = O.secondary_sort(positions(spark, sf).select("mmsi", "ts"), "mmsi", ["ts"], 4)
    rows = df.withColumn("pid", F.spark_partition_id()).collect()
    seq = [(r.pid, r.mmsi, r.ts) for r in rows]
    assert [(m, t) for _, m, t in sorted(seq)] == sorted((m, t) for _, m, t in seq)


def test_range_partitions_are_disjoint(spark, sf):
    r = R.repartition_by_range(retail(spark, sf, "o_custkey").dropna(), 10, "o_custkey")
    ranges = (r.withColumn("pid", F.spark_partition_id()).groupBy("pid")
              .agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi")).orderBy("pid").collect())
    for a, b in zip(ranges, ranges[1:]):
        assert a.hi < b.lo


def test_num_and_nonempty_partitions(spark, sf):
    assert R.num_partitions(R.coalesce_n(R.repartition_n(flights(spark, sf), 8), 2)) == 2


def test_glom_is_exact_beside_nulls(spark, sf):
    rows = [(2 ** 53 + 1, "a"), (None, None), (2 ** 53, "b")]
    g = R.glom(spark.createDataFrame(rows, "k long, t string").coalesce(1)).collect()
    assert len(g) == 1 and [tuple(r) for r in g[0].rows] == rows
    assert R.glom(spark.createDataFrame([], "k long").coalesce(1)).first().rows == []


def test_crosstab_wide_matches_long(spark, sf):
    wide = PLANS["crosstab_wide"].fn(spark, sf)
    long_ = retail(spark, sf, "l_quantity", "n_name").groupBy("n_name", "l_quantity").count()
    w_total = wide.select(sum(F.col(c) for c in wide.columns[1:]).alias("t")).agg(F.sum("t")).first()[0]
    assert w_total == long_.agg(F.sum("count")).first()[0]
    assert wide.columns[0] == "n_name_l_quantity"


def test_foreach_partition_runs_per_partition(spark, sf):
    acc = spark.sparkContext.accumulator(0)
    R.foreach_partition(R.repartition_n(flights(spark, sf), 3), lambda it: acc.add(1))
    assert acc.value == 3


def test_layout_plans_return_every_row(spark, sf):
    def rows(df):
        return sorted(tuple(r) for r in df.collect())
    assert rows(PLANS["secondary_sort"].fn(spark, sf).select("mmsi", "ts")) == rows(positions(spark, sf).select("mmsi", "ts"))
    for key in ("repartition_n", "coalesce_n"):
        assert rows(PLANS[key].fn(spark, sf).select("dest", "origin", "cnt")) == rows(flights(spark, sf)), key


def test_secondary_sort_of_a_vessel_cut_by_time(spark, sf, tmp_path):
    """A vessel of many partitions, one without number, equal times: all records, none steps back, its partitions follow one another."""
    spark.sql("""SELECT id AS event_id, CASE WHEN id % 10 < 8 THEN 1 WHEN id % 10 = 8 THEN 2 + id % 7 END AS user_id,
                 timestamp_seconds(pmod(id * 7919, 5000)) AS ts, 1.0D AS value FROM range(20000)""").write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = PLANS["secondary_sort"].fn(spark, str(tmp_path)).groupBy("mmsi").agg(
            F.count(F.lit(1)).alias("n"), F.min("n_records").alias("lo"), F.max("n_records").alias("hi"),
            F.bool_or("back").alias("back"), F.bool_and("together").alias("together")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert {r.mmsi: r.n for r in got}[1] == 16000 and {r.mmsi: r.n for r in got}[None] == 2000
    assert all(r.n == r.lo == r.hi and not r.back and r.together for r in got)
