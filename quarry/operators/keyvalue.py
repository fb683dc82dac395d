"""Key/value operators on two-column tables.

A pair RDD becomes a DataFrame ``(key, value)``. Every per-key reduction runs
as partial + final hash aggregation; no operator materialises all values of a
key (``groupByKey``'s iterable) - the list-valued results are run-length
encoded (distinct value, count), bounded by the number of distinct values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import udaf
from .aggregates import value_counts


def key_by(df: DataFrame, fn: Callable[[Column], Column], source: str = "value",
           key: str = "key") -> DataFrame:
    """Derive the key from the value."""
    return df.select(fn(F.col(source)).alias(key), F.col(source).alias("value"))


def first_letter_lower(c: Column) -> Column:
    return F.lower(F.substring(c, 1, 1))


def keys(df: DataFrame) -> DataFrame:
    return df.select("key")


def values(df: DataFrame) -> DataFrame:
    return df.select("value")


def lookup_key(df: DataFrame, key) -> DataFrame:
    """Values stored under one key (a filter pushed to the scan where possible)."""
    return df.where(F.col("key") == F.lit(key)).select("value")


def map_values(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn("value", fn(F.col("value")))


def flat_map_values(df: DataFrame, fn: Callable[[Column], Column]) -> DataFrame:
    """``fn`` returns an array per value; one output row per element, key kept."""
    return df.select("key", F.explode(fn(F.col("value"))).alias("value"))


def count_by_key(df: DataFrame) -> DataFrame:
    return df.groupBy("key").agg(F.count(F.lit(1)).alias("count"))


def reduce_by_key(df: DataFrame, agg=F.sum, name: str = "value") -> DataFrame:
    """Per-key reduction with map-side combine (``reduceByKey``)."""
    return df.groupBy("key").agg(agg("value").alias(name))


def group_by_key_reduce(df: DataFrame, agg=F.sum, name: str = "value") -> DataFrame:
    """``groupByKey`` followed by a reduce of each key's values.

    Same result as :func:`reduce_by_key`. The grouped iterable is never built:
    Spark's partial aggregation reduces inside each map task, which is the
    reason the reference recommends ``reduceByKey`` over ``groupByKey``.
    """
    return reduce_by_key(df, agg, name)


_JVM_FOLDS = {"sum": (F.sum, lambda a, z: a + z), "min": (F.min, F.least), "max": (F.max, F.greatest)}


def aggregate_by_key(df: DataFrame, op="sum", zero=None, name: str = "value") -> DataFrame:
    """``aggregateByKey(zero)(seqOp, combOp)``.

    A built-in associative ``op`` ("sum", "min", "max") folds and merges in the JVM
    (partial aggregation in the map task, merge after the shuffle) in the type of
    the values. ``zero``, if given, takes part once per key, so a key without a
    value gives it (without ``zero``: null). A :class:`~quarry.operators.udaf.DecomposableAggregate`
    runs its vectorised update in the map task and its merge in the JVM.
    """
    if isinstance(op, str):
        agg, with_zero = _JVM_FOLDS[op]
        folded = df.groupBy("key").agg(agg("value").alias(name))
        if zero is None:
            return folded
        z = F.lit(zero).cast(folded.schema[name].dataType)
        return folded.withColumn(name, F.when(F.col(name).isNull(), z).otherwise(with_zero(F.col(name), z)))
    return udaf.aggregate(df, ["key"], op, alias=name)


def fold_by_key(df: DataFrame, op: str = "sum", zero=None, name: str = "value") -> DataFrame:
    """``foldByKey(zero)(op)``: one function for both the fold and the merge."""
    return aggregate_by_key(df, op, zero, name)


def combine_by_key_lists(df: DataFrame, num_partitions: int = 10) -> DataFrame:
    """``combineByKey`` to a list of values per key, in ``num_partitions`` partitions.

    The combined list is kept run-length encoded: ``values`` (sorted distinct) and
    ``counts``; expanding it gives the multiset of the key's values.
    """
    return value_counts(df, ["key"], "value").repartition(num_partitions, "key")
