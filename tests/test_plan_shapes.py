"""Physical-plan checks: shuffles, pushdown, broadcasts and Python boundaries."""

import pytest

from quarry.plans import PLANS


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, sf):
    p = _plan(PLANS["ts_literal_compare"].fn(spark, sf))
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate," in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_native_plans_stay_in_the_jvm(spark, sf):
    for key in ("window_running", "rank", "trajectory_build", "grouping_sets", "pivot", "zip_positional",
                "aggregate_by_key", "combine_by_key"):
        p = _plan(PLANS[key].fn(spark, sf))
        assert "Python" not in p and "ArrowEval" not in p and "MapInPandas" not in p, key


def _executed(df) -> str:
    """The plan that ran, after the adaptive changes."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_trajectory_shuffles(spark, sf):
    # the records once by (vessel, minute), their counts by (vessel, minute) and by vessel, the offsets by
    # (vessel, minute), and the partial trajectories
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _executed(PLANS["trajectory_build"].fn(spark, sf))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning") <= 5
    assert "SinglePartition" not in p and "Python" not in p


def test_small_lookup_is_broadcast_without_being_told(spark, sf):
    assert "BroadcastHashJoin" in _executed(PLANS["broadcast_lookup"].fn(spark, sf))


def test_join_has_no_shuffle_ahead_of_a_broadcast(spark, sf):
    p = _executed(PLANS["join_inner"].fn(spark, sf))
    assert "BroadcastHashJoin" in p and "REPARTITION" not in p and "hashpartitioning" not in p


def test_aggregations_are_partial_before_the_shuffle(spark, sf):
    for key in ("count_by_key", "reduce_by_key", "group_by_key", "collect_set", "value_counts"):
        p = _plan(PLANS[key].fn(spark, sf))
        assert "partial_" in p, key


def test_flagship_reads_two_columns(spark, sf):
    p = _plan(PLANS["trajectory_core"].fn(spark, sf))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in p


FILTERS = {"where_sql": "orders", "where_eq": "orders", "filter_column": "orders", "filter_lambda": "orders", "where_or": "orders",
           "where_chain": "orders", "named_predicate": "lineitem", "eq_three_valued": "lineitem", "is_not_null": "lineitem",
           "contains": "part", "length_filter": "part", "ts_literal_compare": "lineitem"}


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_filters_keep_a_part_of_the_rows_at_every_scale(spark, sf_dir):
    for key, name in FILTERS.items():
        kept, all_ = PLANS[key].fn(spark, sf_dir).count(), spark.read.parquet(f"{sf_dir}/{name}.parquet").count()
        assert 0 < kept < all_, (key, kept, all_)


def test_filters_are_pushed_into_the_scan(spark, sf):
    for key, pushed in (("where_sql", "LessThan(o_totalprice,150000.0)"), ("filter_column", "GreaterThanOrEqual(o_totalprice,150000.0)"),
                        ("where_or", "Or(GreaterThan(o_totalprice,300000.0),LessThan(o_totalprice,50000.0))"),
                        ("where_eq", "EqualTo(o_orderpriority,1-URGENT)"), ("where_chain", "LessThan(o_totalprice,200000.0)")):
        assert pushed in _plan(PLANS[key].fn(spark, sf)), key
