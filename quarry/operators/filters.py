"""Filters and predicates.

Predicates stay native expressions so that Catalyst combines chained filters
and pushes them into the Parquet scan. A host-language row predicate is only
offered in vectorised form (:func:`filter_vectorized`).
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    return df.where(predicate)


def where_all(df: DataFrame, *predicates: Column | str) -> DataFrame:
    """Conjunction by chaining (merged into one Filter by the optimizer)."""
    for p in predicates:
        df = df.where(p)
    return df


def where_any(df: DataFrame, *predicates: Column) -> DataFrame:
    cond = predicates[0]
    for p in predicates[1:]:
        cond = cond | p
    return df.where(cond)


def filter_vectorized(df: DataFrame, fn: Callable[..., pd.Series], *cols: str) -> DataFrame:
    """Keep rows where ``fn(*series)`` is True; ``fn`` sees Arrow batches as pandas.

    Only the named columns cross to Python; prefer a native predicate when one exists.
    """
    @F.pandas_udf("boolean")
    def _pred(*series: pd.Series) -> pd.Series:
        return fn(*series).fillna(False).astype(bool)

    return df.where(_pred(*cols))


def ts_literal(text: str, ntz: bool = True) -> Column:
    """A timestamp literal from text (NTZ by default, matching Parquet NTZ columns)."""
    return F.lit(text).cast("timestamp_ntz" if ntz else "timestamp")


def grouping_level(df: DataFrame, level: int, gid: str = "gid") -> DataFrame:
    """Select one level of a rollup/cube result by its ``grouping_id``."""
    return df.where(F.col(gid) == level)
