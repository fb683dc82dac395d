"""Projections: thin, Catalyst-visible wrappers.

Each function takes and returns a DataFrame; column arguments are names or
``Column`` objects so callers can late-bind (``F.col``) or bind to a frame
(``df["c"]``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import DISCOUNT_FACTOR, DISCOUNT_MIN_QUANTITY, WRAP_MARK


def select_names(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names)


def select_columns(df: DataFrame, *cols: Column) -> DataFrame:
    return df.select(*cols)


def select_exprs(df: DataFrame, *exprs: str) -> DataFrame:
    """SQL-text projections, e.g. ``"cnt * 3 AS my_count"``."""
    return df.selectExpr(*exprs)


def select_star_plus(df: DataFrame, **computed: Column | str) -> DataFrame:
    """All columns plus named computed ones."""
    extra = [(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in computed.items()]
    return df.select("*", *extra)


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns (one projection, not one per column)."""
    return df.withColumns(dict(columns))


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Change column types; ``safe=True`` gives null instead of an error on bad values."""
    return df.withColumns({c: (F.col(c).try_cast(t) if safe else F.col(c).cast(t))
                           for c, t in types.items()})


def discounted_price(quantity: str | Column, price: str | Column, min_qty: int = DISCOUNT_MIN_QUANTITY,
                     factor: float = DISCOUNT_FACTOR) -> Column:
    """Conditional value: the price, reduced by ``factor`` from ``min_qty`` items on."""
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(price) if isinstance(price, str) else price
    return F.when(q < min_qty, p).otherwise(p * factor)


def flag_columns(df: DataFrame, source: str, words: Iterable[str], prefix: str = "is_",
                 keep_all: bool = True) -> DataFrame:
    """One Boolean column per word: does ``source`` contain the upper-cased word."""
    flags = [F.col(source).contains(w.upper()).alias(f"{prefix}{w.lower()}") for w in words]
    return df.select(*flags, *(["*"] if keep_all else []))


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Unique, increasing (per partition), non-consecutive 64-bit id; no shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def pack_struct(df: DataFrame, name: str = "record", cols: Iterable[str] | None = None) -> DataFrame:
    """Whole row (or the named columns) as one struct column."""
    return df.select(F.struct(*(list(cols) if cols else ["*"])).alias(name))


def unpack_struct(df: DataFrame, name: str = "record") -> DataFrame:
    return df.select(f"{name}.*")


def wrap_text(c: str | Column, left: str = WRAP_MARK, right: str = WRAP_MARK) -> Column:
    """Per-row map of one value: ``left + value + right``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(left), col, F.lit(right))


def explode_chars(df: DataFrame, source: str, name: str = "ch", lower: bool = True) -> DataFrame:
    """One row per character of ``source`` (flat map word -> characters)."""
    src = F.lower(source) if lower else F.col(source)
    return df.select("*", F.explode(F.split(src, "")).alias(name)).where(F.length(name) > 0)
