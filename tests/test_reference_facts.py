"""Facts stated in the reference's comments and the traps of SURVEY 2.14, on inline data."""

import pytest
from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.functions import udfs as U
from quarry.operators import aggregates as A
from quarry.operators import ordering as O
from quarry.operators import partitioning as R
from quarry.operators import trajectory as TR
from quarry.operators import windows as W


def test_rank_versus_dense_rank(spark):
    df = spark.createDataFrame([(1, q) for q in (9, 7, 7, 5, 5, 5, 1)], "k int, q int")
    r = W.ranks(df, ["k"], "q", descending=True).orderBy(F.desc("q")).collect()
    assert [x["rank"] for x in r] == [1, 2, 2, 4, 4, 4, 7]
    assert [x["dense_rank"] for x in r] == [1, 2, 2, 3, 3, 3, 4]


def test_grouping_levels(spark):
    df = spark.createDataFrame([("d1", "A", 1), ("d1", "B", 2), ("d2", "A", 3), (None, "A", 4)],
                               "d string, c string, q int")
    ru = A.rollup(df, ["d", "c"], F.sum("q").alias("s"))
    assert {r.gid for r in ru.collect()} == {0, 1, 3}
    assert ru.where("gid = 3").first().s == 6          # the null date was removed first
    cu = A.cube(df, ["d", "c"], F.sum("q").alias("s"))
    assert {r.gid for r in cu.collect()} == {0, 1, 2, 3}


def test_pivot_column_names(spark):
    df = spark.createDataFrame([("d1", "A", 1), ("d1", "B", 2), ("d2", "A", 3)], "d string, c string, q int")
    p = A.pivot(df, ["d"], "c", F.sum("q").alias("total_qty"), F.avg("q").alias("avg_qty"), values=["A", "B"])
    assert p.columns == ["d", "A_total_qty", "A_avg_qty", "B_total_qty", "B_avg_qty"]
    assert p.where("d = 'd2'").first().B_total_qty is None


def test_partition_counts_after_repartition(spark):
    df = spark.range(1000)
    assert R.num_partitions(R.repartition_n(df, 5)) == 5
    assert R.num_partitions(R.repartition_by(df, F.col("id") % 10, n=10)) == 10
    assert R.num_partitions(R.coalesce_n(R.repartition_n(df, 20), 10)) == 10


def test_union_needs_same_columns(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ValueError):
        O.union_by_position(a, a.select("a"))
    assert O.union_by_name(a, a.select("b", "a")).count() == 2


def test_udf_double_on_integer_input_is_cast(spark):
    df = spark.createDataFrame([(2,), (3,)], "n int")
    vals = [r[0] for r in df.select(U.cube_vec(F.col("n").cast("double"))).collect()]
    assert vals == [8.0, 27.0]
    assert [r[0] for r in df.select(U.cube_udf()(F.col("n").cast("double"))).collect()] == [8.0, 27.0]


def test_minutes_to_millis_has_no_32_bit_overflow(spark):
    v = spark.range(1).select(TR.minutes_to_millis(F.lit(40_000)).alias("ms")).first().ms
    assert v == 2_400_000_000


def test_size_of_null_is_null_and_bad_index_is_null(spark):
    r = spark.createDataFrame([(None,)], "a array<int>").select(
        F.size("a").alias("n"), S.element(F.array(F.lit(1)), 3).alias("e")).first()
    assert r.n is None and r.e is None


def test_shortest_word_is_deterministic(spark):
    df = spark.createDataFrame([("here",), ("are",), ("some",), ("you",), ("for",)], "w string")
    assert df.agg(A.shortest("w")).first()[0] == "are"


def test_date_difference_sign(spark):
    r = spark.range(1).select(F.datediff(F.date_sub(F.lit("2020-05-01").cast("date"), 7),
                                         F.lit("2020-05-01").cast("date")).alias("d")).first()
    assert r.d == -7
