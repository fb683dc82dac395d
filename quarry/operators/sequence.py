"""Positions and predecessors inside ordered key groups, without hot tasks.

A plain ``row_number().over(Window.partitionBy(key).orderBy(t))`` puts every
row of a key into one task; one vessel (or user, or customer) holding a third
of all rows would then run as a single straggler. These helpers split each
key group further by an order-preserving *bucket* (e.g. the hour of the
timestamp), so the expensive per-row window runs per (key, bucket):

1. count rows per (key, bucket) - partial aggregation, a small shuffle;
2. running sum of those counts per key over the buckets - a window over the
   small count table gives each bucket its offset inside the key;
3. join the offsets back on (key, bucket) and number rows inside the bucket.

The result equals the global per-key numbering for any bucket expression that
is monotone non-decreasing in the ordering. Only the count table is ever
grouped by the key alone, and it holds one row per (key, bucket). The plan is
the same for every key, whatever its size: no job runs while it is built, and
nothing about the data goes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B, _N, _OFF, _KB = "_q_bucket", "_q_n", "_q_offset", "_q_kb"


def time_bucket(ts: str | Column, seconds: int = 60) -> Column:
    """Order-preserving bucket of a timestamp (TIMESTAMP or TIMESTAMP_NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(c) / F.lit(seconds))


def value_bucket(v: str | Column, width: int) -> Column:
    """Order-preserving bucket of a number."""
    c = F.col(v) if isinstance(v, str) else v
    return F.floor(c / F.lit(width))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Equi-join on ``keys`` where null matches null.

    The keys are packed into one struct column: struct equality treats null
    fields as equal, and the join stays a plain hash-partitioned equi-join.
    """
    return struct_join(left, right, keys).drop(_KB)


def struct_join(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str = _KB) -> DataFrame:
    """Join on ``struct(keys)`` and keep that struct as column ``name``.

    A window partitioned by the same struct column reuses the join's hash
    partitioning, so the rows are shuffled once for both.
    """
    keys = list(keys)
    lk = left.withColumn(name, F.struct(*keys))
    rk = right.select(F.struct(*keys).alias(name), *[c for c in right.columns if c not in keys])
    return lk.join(rk, name)


def bucket_order(df: DataFrame, bucket: str, nulls_last: bool = False, descending: bool = False) -> list[Column]:
    """How buckets are ordered, so that they follow the rows' own order.

    Ascending, with null buckets where ``order`` puts null values. With
    ``descending`` the bucket is taken the other way round; of a struct bucket
    only its first field is (``ORDER BY value DESC, ties ASC``).
    """
    b = F.col(bucket)
    if descending:
        kind = df.schema[bucket].dataType
        if isinstance(kind, T.StructType):
            first, *rest = kind.fieldNames()
            return [b[first].desc_nulls_last(), *[b[f].asc_nulls_first() for f in rest]]
        return [b.desc_nulls_last()]
    return [b.asc_nulls_last() if nulls_last else b.asc_nulls_first()]


def ordered_position(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     bucket: Column, name: str = "pos", nulls_last: bool = False,
                     descending: bool = False) -> DataFrame:
    """Add ``name``: 1-based position of each row in its key group under ``order``.

    ``bucket`` must be monotone non-decreasing in ``order`` inside a key
    (non-increasing with ``descending``, see :func:`bucket_order`), with a null
    bucket exactly for rows whose leading order value is null; set
    ``nulls_last`` when ``order`` puts those rows last. Ties in ``order`` get
    distinct positions in unspecified order, as with ``row_number``.
    """
    keys = list(keys)
    b = df.withColumn(_B, bucket)
    counts = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias(_N))
    before = (Window.partitionBy(*keys).orderBy(*bucket_order(b, _B, nulls_last, descending))
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*keys, _B, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    joined = struct_join(b, offsets, keys + [_B])
    inner = Window.partitionBy(_KB).orderBy(*order)
    return (joined.withColumn(name, F.col(_OFF) + F.row_number().over(inner))
            .drop(_B, _OFF, _KB))


def ordered_previous(df: DataFrame, keys: Sequence[str], order: str, bucket: Column,
                     cols: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<c>`` for each of ``cols``: the value on the preceding row of
    the key group under ascending ``order``, nulls first (null on the first
    row), as ``lag`` would. Rows with equal ``order`` are taken in the order of
    ``cols``, inside a bucket and across its border alike."""
    keys, cols = list(keys), list(cols)
    b = df.withColumn(_B, bucket)
    ends = [order, *[c for c in cols if c != order]]
    # the largest struct is the last row: null fields are smallest, as in the sort below
    last = b.groupBy(*keys, _B).agg(F.max(F.struct(*ends)).alias("_q_last"))
    w_keys = Window.partitionBy(*keys).orderBy(*bucket_order(b, _B))
    carry = last.select(*keys, _B, F.lag("_q_last").over(w_keys).alias("_q_carry"))
    joined = struct_join(b, carry, keys + [_B])
    inner = Window.partitionBy(_KB).orderBy(*ends)
    first = F.row_number().over(inner) == 1
    out = joined.withColumns({f"{prefix}{c}": F.when(first, F.col("_q_carry")[c]).otherwise(F.lag(c).over(inner))
                              for c in cols})
    return out.drop(_B, _KB, "_q_carry")
