"""Aggregations.

All of these run as Spark's two-phase hash aggregation: a partial aggregate
inside each map task, a shuffle of one buffer per (task, group), and a final
merge. A key holding a third of the rows therefore costs one buffer per task,
not one task. Lists are only collected per group whose size is bounded by the
data model; for unbounded groups use :func:`value_counts` (a run-length form
bounded by the number of distinct values).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT_AGGS = {
    "count": F.count, "min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg, "mean": F.avg,
    "first": F.first, "last": F.last, "collect_set": F.collect_set, "collect_list": F.collect_list,
    "count_distinct": F.count_distinct, "stddev": F.stddev, "variance": F.variance,
}


def pair_aggregates(df: DataFrame, group: Sequence[str], pairs: Iterable[tuple[str, str]],
                    name: str = "{fn}_{col}") -> DataFrame:
    """Aggregates given as (column, function name) pairs; a column may repeat.

    (A Python dict would silently drop repeated columns, so pairs are a list.)
    Set-valued results are sorted so that they are deterministic.
    """
    cols = []
    for col, fn in pairs:
        agg = _SHORT_AGGS[fn](col)
        if fn in ("collect_set", "collect_list"):
            agg = F.sort_array(agg)
        cols.append(agg.alias(name.format(fn=fn, col=col)))
    return df.groupBy(*group).agg(*cols)


def numeric_summary(df: DataFrame, group: Sequence[str], stats=("min", "max", "avg")) -> DataFrame:
    """``min``/``max``/``mean`` over every numeric non-key column, named ``<stat>_<col>``."""
    numeric = [f.name for f in df.schema.fields
               if f.name not in group and f.dataType.typeName() in
               ("integer", "long", "double", "float", "short", "byte", "decimal")]
    return df.groupBy(*group).agg(*[_SHORT_AGGS[s](c).alias(f"{s}_{c}") for c in numeric for s in stats])


def ordered_first(value: str, *order: str) -> Column:
    """First value under an explicit order (deterministic ``first``)."""
    return F.min_by(value, F.struct(*order, value))


def ordered_last(value: str, *order: str) -> Column:
    return F.max_by(value, F.struct(*order, value))


def moments(c: str, prefix: str = "") -> list[Column]:
    """Population skewness and excess kurtosis plus sample/population variance."""
    return [F.var_samp(c).alias(f"{prefix}var_samp"), F.var_pop(c).alias(f"{prefix}var_pop"),
            F.skewness(c).alias(f"{prefix}skewness"), F.kurtosis(c).alias(f"{prefix}kurtosis")]


def value_counts(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Run-length form of ``collect_list``: per group, the sorted distinct values and
    how often each occurs (``values``, ``counts``). Pre-aggregated per (group, value)
    before any list is built, so the list is bounded by the distinct values."""
    per_value = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    packed = per_value.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct(value, "_n"))).alias("_vc"))
    return packed.select(*group, F.transform("_vc", lambda x: x[value]).alias("values"),
                         F.transform("_vc", lambda x: x["_n"]).alias("counts"))


def sorted_list(value: str | Column) -> Column:
    """``collect_list`` made deterministic (for groups bounded by the data model)."""
    return F.sort_array(F.collect_list(value))


def sorted_set(value: str | Column) -> Column:
    return F.sort_array(F.collect_set(value))


# ---------------------------------------------------------------------------
# grouping sets, rollup, cube, pivot
# ---------------------------------------------------------------------------

def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], cols: Sequence[str],
                  *aggs: Column, gid: str | None = "gid") -> DataFrame:
    """Aggregate over several groupings at once (one Expand, one shuffle)."""
    extra = [F.grouping_id().alias(gid)] if gid else []
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(*aggs, *extra)


def rollup(df: DataFrame, cols: Sequence[str], *aggs: Column, gid: str | None = "gid",
           drop_null_keys: bool = True) -> DataFrame:
    """Hierarchical subtotals. Data nulls in the keys are removed first (they
    could not be told from subtotal rows otherwise); ``gid`` tells the level."""
    src = df.dropna(subset=list(cols)) if drop_null_keys else df
    extra = [F.grouping_id().alias(gid)] if gid else []
    return src.rollup(*cols).agg(*aggs, *extra)


def cube(df: DataFrame, cols: Sequence[str], *aggs: Column, gid: str | None = "gid",
         drop_null_keys: bool = True) -> DataFrame:
    src = df.dropna(subset=list(cols)) if drop_null_keys else df
    extra = [F.grouping_id().alias(gid)] if gid else []
    return src.cube(*cols).agg(*aggs, *extra)


def pivot(df: DataFrame, group: Sequence[str], column: str, *aggs: Column, values: Sequence) -> DataFrame:
    """One row per group, one column per (pivot value, aggregate): ``<value>_<alias>``.

    The values make the columns, so the caller names them; where they are not
    known, or are many, :func:`pivot_long` gives the same numbers as rows.
    """
    return df.groupBy(*group).pivot(column, list(values)).agg(*aggs)


def pivot_long(df: DataFrame, group: Sequence[str], column: str, *aggs: Column) -> DataFrame:
    """The pivot in long form: one row per (group, pivot value present), whatever their number."""
    return df.groupBy(*group, column).agg(*aggs)


def describe_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Typed long form of ``describe``: (column, count, mean, stddev, min, max) per
    numeric column, in one aggregation pass."""
    cols = list(cols) if cols else [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not cols:
        raise ValueError("no numeric column to describe")
    aggs = []
    for c in cols:
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(c).cast("double").alias(f"{c}__mean"),
                 F.stddev_samp(c).cast("double").alias(f"{c}__stddev"),
                 F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (`column`, `count`, mean, stddev, min, max)")


def crosstab_long(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency table in long form: (a, b, count) for each pair present."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence[str]) -> DataFrame:
    """Wide contingency table like ``stat.crosstab``: first column ``a_b``, one column per
    value of ``b`` named (as text; null is ``null``), zero where a pair is absent.
    :func:`crosstab_long` needs no list of values."""
    src = df.select(F.coalesce(F.col(a).cast("string"), F.lit("null")).alias(f"{a}_{b}"),
                    F.coalesce(F.col(b).cast("string"), F.lit("null")).alias("_b"))
    out = pivot(src, [f"{a}_{b}"], "_b", F.count(F.lit(1)), values=values)
    return out.fillna(0)


# ---------------------------------------------------------------------------
# partition-level aggregation and side metrics
# ---------------------------------------------------------------------------

def per_partition_then_total(df: DataFrame, slice_col: str | Column, value: str,
                             within=F.max, across=F.sum, name: str = "result") -> DataFrame:
    """``aggregate(zero)(within, across)``: reduce each slice with ``within``, then
    combine the slice results with ``across``. ``slice_col`` names the slice (an
    explicit column, or ``F.spark_partition_id()`` for physical partitions)."""
    per = df.groupBy(slice_col if isinstance(slice_col, Column) else F.col(slice_col)
                     ).agg(within(value).alias("_part"))
    return per.agg(across("_part").alias(name))


def tree_total(df: DataFrame, slice_col: str, value: str, fanout: int = 16,
               within=F.max, across=F.sum, name: str = "result") -> DataFrame:
    """Same result as :func:`per_partition_then_total`, reduced in levels: each
    slice is first split into ``fanout`` hash sub-slices (a hot slice is spread
    over many tasks), sub-results are merged with ``within``, then combined."""
    sub = F.pmod(F.xxhash64(*df.columns), F.lit(fanout))
    lvl1 = df.groupBy(slice_col, sub.alias("_sub")).agg(within(value).alias("_v"))
    lvl2 = lvl1.groupBy(slice_col).agg(within("_v").alias("_part"))
    return lvl2.agg(across("_part").alias(name))


def observe_metrics(df: DataFrame, name: str, *metrics: Column):
    """Attach side metrics computed while the result is produced (no extra job).

    Returns ``(observed_df, Observation)``; read ``observation.get`` after an action.
    Unlike accumulators updated in transformations, observed values are tied to
    the result and do not double count on task retries.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, *metrics), obs


def shortest(value: str) -> Column:
    """Shortest value; ties go to the smallest text (deterministic reduce)."""
    return F.min_by(value, F.struct(F.length(value), F.col(value)))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
