"""Window functions, with forms that spread a hot key.

``Window.partitionBy(k)`` sends each key's rows to one task, which is the best
plan where groups are known to be small; ``ranks`` and ``range_frame_sum`` use
it. Running frames and row numbers are computed per (key, bucket) with totals
carried from the preceding buckets (see :mod:`.sequence`), one plan for all
keys, so that no task holds a whole key group; ``ranks_spread`` does the same
for ranks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .sequence import _KB, _null_safe_join, bucket_order, ordered_position, struct_join

_B = "_w_bucket"


def desc_bucket(value: str, *ties: str, spread: int = 0) -> Column:
    """A bucket for ``ORDER BY value DESC [, ties...]`` that can split a hot key finely;
    use it with ``descending=True``.

    The value itself leads (nothing is negated, so NaN and the smallest integer
    keep their place). With no tie columns, ``spread`` > 0 adds a hash
    sub-bucket: rows with equal value are then ordered by that hash, which is a
    valid order of ties.
    """
    fields = [F.col(value).alias("v"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)]]
    if spread and not ties:
        fields.append(F.pmod(F.xxhash64("*"), F.lit(spread)).alias("h"))
    return F.struct(*fields)


def running_window(keys: Sequence[str], order: Sequence[Column | str]):
    """ROWS frame from the start of the partition to the current row."""
    return (Window.partitionBy(*keys).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   bucket: Column, value: str, sum_name: str = "running_sum",
                   max_name: str = "running_max", nulls_last: bool = False,
                   descending: bool = False) -> DataFrame:
    """Running sum and max of ``value`` per key in ``order`` (ROWS frame), computed per
    (key, bucket) plus carried totals of the preceding buckets. ``bucket``,
    ``nulls_last`` and ``descending`` as in :func:`.sequence.ordered_position`."""
    keys = list(keys)
    b = df.withColumn(_B, bucket)
    per = b.groupBy(*keys, _B).agg(F.sum(value).alias("_s"), F.max(value).alias("_m"))
    before = (Window.partitionBy(*keys).orderBy(*bucket_order(b, _B, nulls_last, descending))
              .rowsBetween(Window.unboundedPreceding, -1))
    carry = per.select(*keys, _B, F.sum("_s").over(before).alias("_cs"), F.max("_m").over(before).alias("_cm"))
    j = struct_join(b, carry, keys + [_B])
    inner = Window.partitionBy(_KB).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    s_in, m_in = F.sum(value).over(inner), F.max(value).over(inner)
    return (j.withColumn(sum_name, F.when(s_in.isNull(), F.col("_cs"))
                         .otherwise(F.coalesce(F.col("_cs"), F.lit(0)) + s_in))
             .withColumn(max_name, F.greatest(F.col("_cm"), m_in))
             .drop(_B, _KB, "_cs", "_cm"))


def range_frame_sum(df: DataFrame, keys: Sequence[str], order: str, value: str,
                    lower: int, upper: int, descending: bool = False,
                    name: str = "range_sum") -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY order [DESC] RANGE BETWEEN lower AND upper)``."""
    o = F.col(order).desc() if descending else F.col(order).asc()
    w = Window.partitionBy(*keys).orderBy(o).rangeBetween(lower, upper)
    return df.withColumn(name, F.sum(value).over(w))


def _best_first(order: str, descending: bool) -> Column:
    return F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()


def ranks(df: DataFrame, keys: Sequence[str], order: str, descending: bool = False,
          rank_name: str = "rank", dense_name: str = "dense_rank") -> DataFrame:
    """``rank`` (with gaps) and ``dense_rank`` per key by one ordering column."""
    w = Window.partitionBy(*keys).orderBy(_best_first(order, descending))
    return df.withColumns({rank_name: F.rank().over(w), dense_name: F.dense_rank().over(w)})


def ranks_spread(df: DataFrame, keys: Sequence[str], order: str, bucket: Column, descending: bool = False,
                 rank_name: str = "rank", dense_name: str = "dense_rank") -> DataFrame:
    """:func:`ranks` for keys of any size: rank = 1 + rows with a better value, dense rank = 1 + distinct
    better values, both running totals over the (key, value) histogram, which is itself cut by ``bucket``
    (monotone in ``order``), so that a key of distinct values is spread too."""
    keys = list(keys)
    hist = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_hn"))
    by = [_best_first(order, descending)]
    placed = ordered_position(hist, keys, by, bucket, dense_name, descending=descending)
    totals = running_totals(placed, keys, by, bucket, "_hn", "_through", "_unused", descending=descending)
    table = totals.select(*keys, order, (F.col("_through") - F.col("_hn") + 1).cast("int").alias(rank_name),
                          F.col(dense_name).cast("int").alias(dense_name))
    return _null_safe_join(df, table, keys + [order])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                bucket: Column, name: str = "row_number", nulls_last: bool = False,
                descending: bool = False) -> DataFrame:
    """``row_number`` per key; ``bucket`` monotone in ``order`` spreads a hot key over tasks."""
    return (ordered_position(df, keys, order, bucket, name, nulls_last, descending)
            .withColumn(name, F.col(name).cast("int")))
