"""Quantiles of groups of any size: mergeable KLL sketches, and exact ones by distributed selection.

A sketch is a binary column of bounded size (Spark's ``kll_sketch_agg_*``): it can be stored, merged over groups and asked later. Exact quantiles need no buffer of a group's
values: sketches bracket each wanted rank, one pass counts what lies below the brackets, and only the rows inside them are ordered, in range slices that cut through hot groups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir
from .slices import running

K = 400                  # of the sketches: rank error about 0.7 % with 99 % confidence
MARGIN = 0.02            # in ranks, on either side of a wanted one


def _kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "bigint"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return "double"
    raise TypeError(f"quantiles of {data_type.simpleString()}: cast to bigint or double")


def _present(df: DataFrame, column: str) -> DataFrame:
    kind = _kind(df.schema[column].dataType)
    value = F.col(column).cast(kind)
    return df.withColumn("_q_v", value).where(value.isNotNull() & ~F.isnan(value) if kind == "double" else value.isNotNull())


def quantile_sketches(df: DataFrame, keys: Sequence[str], column: str, k: int = K, name: str = "sketch") -> DataFrame:
    """A KLL sketch of ``column`` per group; nulls and NaN are left out (a group of only those has no row)."""
    make = F.kll_sketch_agg_bigint if _kind(df.schema[column].dataType) == "bigint" else F.kll_sketch_agg_double
    return _present(df, column).groupBy(*keys).agg(make("_q_v", k).alias(name)).where(F.col(name).isNotNull())


def merge_sketches(sketches: DataFrame, keys: Sequence[str], kind: str, name: str = "sketch") -> DataFrame:
    """The sketches of coarser groups ``keys`` (none: the total) from those of finer ones, without their rows; ``kind`` is ``bigint`` or ``double``."""
    merge = {"bigint": F.kll_merge_agg_bigint, "double": F.kll_merge_agg_double}[kind]
    return sketches.groupBy(*keys).agg(merge(name).alias(name)).where(F.col(name).isNotNull())


def sketch_quantile(sketch: str | Column, kind: str, p: float | Column) -> Column:
    ask = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}[kind]
    return ask(sketch, F.lit(p) if isinstance(p, float) else p)


def exact_quantiles(df: DataFrame, keys: Sequence[str], column: str, probs: Sequence[float], name: str = "quantiles", k: int = K,
                    margin: float = MARGIN) -> DataFrame:
    """``percentile(column, probs)`` per group (linear interpolation, doubles), groups of any size and number of distinct values.

    1. a sketch per group brackets every wanted rank by ``margin`` on either side;
    2. one pass counts each group's rows and those below every bracket, map-side combined;
    3. a bracket that misses its ranks (a sketch is right with a probability) becomes the whole group, so that the result is exact always;
    4. the values inside the brackets, summed up by value, are put in order by a running count over range slices, and those at the wanted ranks are taken.

    Nulls and NaN are left out. Reads ``df`` three times; about ``2 * margin * len(probs)`` of its rows are shuffled, as (value, count). Groups join as
    they come (null is a group). The brackets (a row per group) and the slices of step 4 are checkpointed while the plan is built.
    """
    kind, keys = _kind(df.schema[column].dataType), list(keys)
    group = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rows = _present(df, column).select(group.alias("g"), F.col("_q_v").alias("v"))
    fence = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), sketch_quantile("sketch", kind, max(0.0, p - margin)).alias("lo"),
                               sketch_quantile("sketch", kind, min(1.0, p + margin)).alias("hi")) for i, p in enumerate(probs)])
    make = F.kll_sketch_agg_bigint if kind == "bigint" else F.kll_sketch_agg_double
    # sketches are random: all later steps, and their retries, must see the same brackets. Groups are structs, so that null keys join
    checkpoint_dir(df.sparkSession)
    fences = rows.groupBy("g").agg(make("v", k).alias("sketch")).select("g", fence.alias("fences")).checkpoint()
    held = rows.join(fences, "g")
    counted = held.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[
        e for i in range(len(probs)) for e in (F.count_if(F.col("v") < F.col("fences")[i]["lo"]).alias(f"below{i}"),
                                               F.count_if(F.col("v") <= F.col("fences")[i]["hi"]).alias(f"upto{i}"))])
    wanted = counted.join(fences, "g").select("g", "n", F.inline(F.array(*[
        F.struct(F.col("fences")[i]["i"].alias("i"), (F.col("fences")[i]["p"] * (F.col("n") - 1)).alias("at"), F.col("fences")[i]["lo"].alias("lo"),
                 F.col("fences")[i]["hi"].alias("hi"), F.col(f"below{i}").alias("below"), F.col(f"upto{i}").alias("upto")) for i in range(len(probs))])))
    # rows number floor(at) and ceil(at) are wanted, from 0; those from `below` to `upto` - 1 lie inside
    inside = (F.floor("at") >= F.col("below")) & (F.ceil("at") < F.col("upto"))
    asked = wanted.select("g", "i", "at", F.when(inside, F.col("lo")).alias("lo"), F.when(inside, F.col("hi")).alias("hi"),
                          F.when(inside, F.col("below")).otherwise(F.lit(0)).alias("below"))
    packed = asked.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "at", "lo", "hi", "below"))).alias("asked"))
    hit = F.filter("asked", lambda a: (a["lo"].isNull()) | ((F.col("v") >= a["lo"]) & (F.col("v") <= a["hi"])))
    values = (rows.join(packed, "g").withColumn("a", F.explode(hit)).groupBy("g", F.col("a.i").alias("i"), F.col("a.at").alias("at"), F.col("a.below").alias("below"), "v")
              .agg(F.count(F.lit(1)).alias("m")))
    flat = values.select(*[F.col(f"g.{c}").alias(f"_q_g{j}") for j, c in enumerate(keys or ["all"])], "i", "at", "below", "v", "m")
    names = [f"_q_g{j}" for j in range(max(len(keys), 1))]
    placed = running(flat, [*names, "i"], ["v"], [("sum", "m", "upto")])
    first, end = F.col("below") + F.col("upto") - F.col("m"), F.col("below") + F.col("upto")
    low, high = F.floor("at"), F.ceil("at")
    taken = placed.select(*names, "i", "at", F.when((low >= first) & (low < end), F.col("v").cast("double")).alias("l"),
                          F.when((high >= first) & (high < end), F.col("v").cast("double")).alias("h")).where("l IS NOT NULL OR h IS NOT NULL")
    both = taken.groupBy(*names, "i", "at").agg(F.max("l").alias("l"), F.max("h").alias("h"))
    share = F.col("at") - F.floor("at")
    # equal neighbours are given as they are; the weighted form is Spark's
    value = F.when(F.col("l") == F.col("h"), F.col("l")).otherwise((1 - share) * F.col("l") + share * F.col("h"))
    out = both.groupBy(*names).agg(F.sort_array(F.collect_list(F.struct("i", value.alias("q")))).alias("q"))
    return out.select(*[F.col(f"_q_g{j}").alias(c) for j, c in enumerate(keys)], F.transform("q", lambda x: x["q"]).alias(name))
