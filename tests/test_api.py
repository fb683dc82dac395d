"""Driver-edge helpers: local sources, side metrics, schema description, time functions."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import aggregates as A
from quarry.plans import PLANS
from quarry.sources import local
from quarry.sources.fixtures import flights
from quarry.sources.materialize import fetch, iterate, schema_table


def test_local_sources(spark):
    words = "here are some words for you".split()
    df = local.from_local(spark, [(w,) for w in words], "word string", num_partitions=2)
    assert df.rdd.getNumPartitions() == 2
    assert sorted(r.word for r in df.collect()) == sorted(words)
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
    recs = local.from_records(spark, [{"x": 1.0, "y": 2.0}, {"y": 3.0}], schema).collect()
    assert [tuple(r) for r in recs] == [(1.0, 2.0), (None, 3.0)]
    assert local.id_range(spark, 10, num_partitions=3).count() == 10


def test_observed_side_metrics(spark, sf):
    fl = flights(spark, sf)
    china = (F.col("dest") == "NATION_5") | (F.col("origin") == "NATION_5")
    observed, obs = A.observe_metrics(fl, "m", F.sum(F.when(china, F.col("cnt"))).alias("china"),
                                      F.sum(F.when(F.col("cnt") % 2 == 0, F.col("cnt"))).alias("even"))
    observed.write.format("noop").mode("overwrite").save()
    got = obs.get
    assert got["china"] == PLANS["metric_sum_where"].fn(spark, sf).first()[0]
    assert got["even"] == PLANS["metric_sum_even"].fn(spark, sf).first()[0]


def test_schema_fetch_and_iterate(spark, sf):
    fl = flights(spark, sf)
    st = [tuple(r) for r in schema_table(spark, fl).collect()]
    assert [s[:2] for s in st] == [("dest", "string"), ("origin", "string"), ("cnt", "int")]
    top = fetch(fl, 3, F.desc("cnt"), "dest", "origin")
    assert len(top) == 3 and top[0].cnt >= top[-1].cnt
    assert sum(1 for _ in iterate(fl)) == fl.count()


def test_package_is_shipped_once(spark):
    from quarry import session
    session.ship_package(spark)
    assert spark.sparkContext.applicationId in session._SHIPPED
    session.ship_package(spark)            # idempotent per application
    # executors can import the package (a Python worker runs this)
    out = spark.range(2).mapInPandas(
        lambda it: (b.assign(m=__import__("quarry").__name__) for b in it), "id long, m string").collect()
    assert {r.m for r in out} == {"quarry"}


def test_cluster_conf_sizes_partitions():
    from quarry.session import cluster_conf
    assert cluster_conf(10 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"
    assert cluster_conf(1 << 40)["spark.sql.shuffle.partitions"] == "4096"
