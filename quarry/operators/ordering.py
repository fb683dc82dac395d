"""Sorts, limits, secondary sort, set operations and sampling."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort(df: DataFrame, *order: Column | str) -> DataFrame:
    """Total order (range shuffle; ascending puts nulls first, descending last)."""
    return df.orderBy(*order)


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First ``k`` rows under a total order; planned as TakeOrderedAndProject
    (each task keeps its own top ``k``, the driver merges ``k`` x tasks rows)."""
    return df.orderBy(*order).limit(k)


def sort_within_partitions(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort each partition; no shuffle."""
    return df.sortWithinPartitions(*order)


def secondary_sort(df: DataFrame, key: str, order: Sequence[str],
                   num_partitions: int | None = None) -> DataFrame:
    """Co-locate and order records by ``(key, *order)``.

    Range partitioning on the composite key (sampled bounds) keeps each key's
    records contiguous and ordered across partitions while splitting a hot key
    over several partitions by time - unlike hashing on the key alone, which
    would put a hot key into a single task.
    """
    cols = [key, *order]
    parts = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    return parts.sortWithinPartitions(*cols)


def union_by_position(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append by column position, duplicates kept (column count and types must agree)."""
    if len(a.columns) != len(b.columns):
        raise ValueError("union by position needs the same number of columns")
    return a.union(b)


def union_by_name(a: DataFrame, b: DataFrame, allow_missing: bool = False) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=allow_missing)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Sample without replacement, each row kept with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def _hash_unit(cols: Sequence[str], seed: int) -> Column:
    # uniform in [0, 1) from a 64-bit hash of the row's identifying columns
    return (F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(1 << 30)) / F.lit(float(1 << 30)))


def hash_sample(df: DataFrame, fraction: float, id_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """Reproducible sample: independent of partitioning and stable under task retries."""
    return df.where(_hash_unit(id_cols, seed) < F.lit(fraction))


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 42) -> list[DataFrame]:
    """Disjoint random split with the given weights (Spark's sampler)."""
    return df.randomSplit(list(weights), seed)


def hash_split(df: DataFrame, weights: Sequence[float], id_cols: Sequence[str], seed: int = 42) -> list[DataFrame]:
    """Disjoint, complete, reproducible split by a hash of ``id_cols``."""
    total = float(sum(weights))
    u = _hash_unit(id_cols, seed)
    bounds, acc = [], 0.0
    for w in weights:
        lo, acc = acc, acc + w / total
        bounds.append((lo, acc))
    bounds[-1] = (bounds[-1][0], 1.0 + 1e-9)
    return [df.where((u >= F.lit(lo)) & (u < F.lit(hi))) for lo, hi in bounds]


def mark_steps_back(df: DataFrame, columns: Sequence[str], name: str = "back") -> DataFrame:
    """``df`` with ``name``: whether a row lies before its predecessor in its partition by ``columns`` ascending, nulls first. Partitions stay as they are."""
    columns = list(columns)

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            here = pa.Table.from_batches([batch]).select(columns)
            before = pa.concat_tables([last if last is not None else here.slice(0, 1), here.slice(0, here.num_rows - 1)])
            back, same = np.zeros(here.num_rows, dtype=bool), np.ones(here.num_rows, dtype=bool)
            for c in columns:
                now, prior = here.column(c), before.column(c)
                no_now, no_prior = now.is_null().to_numpy(), prior.is_null().to_numpy()
                back |= same & (pc.fill_null(pc.less(now, prior), False).to_numpy() | no_now & ~no_prior)
                same &= pc.fill_null(pc.equal(now, prior), False).to_numpy() | no_now & no_prior
            last = here.slice(here.num_rows - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(back)], names=[*batch.schema.names, name])
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.BooleanType())]))
