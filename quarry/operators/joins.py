"""Joins, lookups, co-grouping and positional zip.

Spark picks the physical join: broadcast when a side is under
``spark.sql.autoBroadcastJoinThreshold`` (re-checked at runtime by AQE),
otherwise sort-merge on hash-partitioned keys, with AQE splitting skewed
partitions. Nothing here forces a broadcast or a shuffle ahead of that choice;
:func:`salted_join` spreads keys that are hot on one side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sequence import ordered_position


def join(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Equi join; Spark picks the physical form and the partitioning."""
    return left.join(right, on, how)


def salted_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], salts: int, how: str = "inner") -> DataFrame:
    """Equi join (inner, left, left_semi or left_anti) whose left keys are spread over
    ``salts`` partitions each, by a hash of the row; every right row is repeated
    ``salts`` times. For a left side with keys too hot for one task and a right
    side of few rows per key."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a salted {how} join would repeat rows of the right side")
    keys = [on] if isinstance(on, str) else list(on)
    cut = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    spread = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return cut.join(spread, [*keys, "_salt"], how).drop("_salt")


def broadcast_lookup(df: DataFrame, lookup: DataFrame, key: str, value: str, default=0,
                     name: str | None = None) -> DataFrame:
    """Enrich rows with ``lookup[value]`` by ``key``; ``default`` where absent.

    Spark broadcasts the lookup when its size in bytes, planned or measured at
    run time, is under ``spark.sql.autoBroadcastJoinThreshold``, and shuffles otherwise.
    """
    out = df.join(lookup.select(key, F.col(value).alias(name or value)), key, "left")
    return out.withColumn(name or value, F.coalesce(F.col(name or value), F.lit(default)))


def cogroup_lists(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                  left_name: str = "left_values", right_name: str = "right_values") -> DataFrame:
    """Per key, the sorted value lists of both sides (empty list where a side has none).

    Each side is reduced to one row per key before the full outer join. The lists are
    as long as a key's rows on that side, so use it on sides whose per-key row count is
    bounded (pre-aggregate first, or use :func:`cogroup_long`).
    """
    lg = left.groupBy(key).agg(F.sort_array(F.collect_list(left_value)).alias(left_name))
    rg = right.groupBy(key).agg(F.sort_array(F.collect_list(right_value)).alias(right_name))
    out = lg.join(rg, key, "full")
    return out.select(key,
                      F.coalesce(left_name, F.array().cast(lg.schema[left_name].dataType)).alias(left_name),
                      F.coalesce(right_name, F.array().cast(rg.schema[right_name].dataType)).alias(right_name))


def cogroup_long(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str,
                 num_partitions: int | None = None) -> DataFrame:
    """Co-grouped records in long form ``(key, side, value)``, clustered by key and
    ordered by (key, side, value) within partitions - no per-key list is built."""
    tagged = (left.select(key, F.lit(0).alias("side"), F.col(left_value).alias("value"))
              .unionByName(right.select(key, F.lit(1).alias("side"), F.col(right_value).alias("value"))))
    parts = tagged.repartition(num_partitions, key) if num_partitions else tagged.repartition(key)
    return parts.sortWithinPartitions(key, "side", "value")


_NUMERIC = ("byte", "short", "integer", "long", "float", "double", "decimal")


def quantile_boundaries(df: DataFrame, column: str, num_buckets: int, accuracy: int = 10_000,
                        per_bucket_sample: int = 64, seed: int = 17) -> list:
    """The distinct approximate ``1/n .. (n-1)/n`` quantiles of ``column``.

    Numeric columns use ``percentile_approx`` (at most ``num_buckets - 1`` values reach
    the driver). Other orderable types use a sample of about ``per_bucket_sample``
    values per bucket (a bounded driver result, as Spark's range partitioner does).
    """
    if df.schema[column].dataType.typeName() in _NUMERIC:
        probs = [i / num_buckets for i in range(1, num_buckets)]
        qs = df.select(F.percentile_approx(column, probs, accuracy)).first()[0] or []
        return sorted({q for q in qs if q is not None})
    present = df.select(column).where(F.col(column).isNotNull())
    target = per_bucket_sample * num_buckets
    n = present.count()
    frac = min(1.0, 2.0 * target / max(n, 1))
    sample = sorted(r[0] for r in present.sample(False, frac, seed).collect())
    if not sample:
        return []
    return sorted({sample[len(sample) * i // num_buckets] for i in range(1, num_buckets)})


def with_quantile_bucket(df: DataFrame, column: str, num_buckets: int, name: str = "_zb") -> DataFrame:
    """Add an order-preserving bucket of ``column`` with about equal row counts per bucket.

    The bucket of a value is the number of boundaries at or below it; nulls get a
    null bucket (ordered first, like nulls in an ascending sort). Numeric columns
    are bucketed by a binary search in the JVM (``Bucketizer``); other orderable
    types by comparing against each boundary.
    """
    bounds = quantile_boundaries(df, column, num_buckets)
    c = F.col(column)
    if not bounds:
        return df.withColumn(name, F.when(c.isNotNull(), F.lit(0)))
    if df.schema[column].dataType.typeName() in _NUMERIC:
        from pyspark.ml.feature import Bucketizer
        splits = [float("-inf")] + [float(b) for b in bounds] + [float("inf")]
        splits = sorted(set(splits))
        tmp = df.withColumn("_zq", c.cast("double"))
        out = Bucketizer(splits=splits, inputCol="_zq", outputCol=name, handleInvalid="keep").transform(tmp)
        return out.withColumn(name, F.when(c.isNotNull(), F.col(name).cast("int"))).drop("_zq")
    arr = F.array(*[F.lit(b) for b in bounds])
    return df.withColumn(name, F.when(c.isNotNull(), F.size(F.filter(arr, lambda b: b <= c))))


def with_row_position(df: DataFrame, order: Sequence[str], num_buckets: int,
                      name: str = "row_pos") -> DataFrame:
    """Add a consecutive 1-based position under ascending ``order`` (ties in unspecified order).

    Rows are bucketed by quantiles of the leading order column, counted per bucket
    (a table of at most ``num_buckets`` rows, so its running offsets are broadcast),
    and numbered inside each bucket. No global single-task window, no dependence on
    physical partition ids.
    """
    b = with_quantile_bucket(df, order[0], num_buckets, "_zb")
    return ordered_position(b, [], list(order), F.col("_zb"), name).drop("_zb")


def zip_positional(a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str],
                   num_buckets: int) -> DataFrame:
    """Pair row i of ``a`` (under ``order_a``) with row i of ``b``; the query fails if
    the two sides differ in length."""
    pa_ = with_row_position(a, order_a, num_buckets, "_zpos")
    pb_ = with_row_position(b, order_b, num_buckets, "_zpos2")
    joined = pa_.join(pb_, pa_["_zpos"] == pb_["_zpos2"], "full")
    # a predicate, so the check cannot be pruned away with its column
    same_length = F.when(F.col("_zpos").isNull() | F.col("_zpos2").isNull(),
                         F.raise_error(F.lit("zip: sides differ in length"))).otherwise(F.lit(True))
    return joined.where(same_length).drop("_zpos", "_zpos2")
