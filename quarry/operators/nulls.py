"""Missing data: dropping, filling, replacing and imputing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed import MISSING_CODE, TRUNCATE_MARKER, TRUNCATE_WIDTH


def null_if(c: str | Column, value) -> Column:
    """Null where the column equals ``value`` (typed literal, no implicit text/number mix)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(col, F.lit(value))


def drop_rows(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with any (``how='any'``) or only (``how='all'``) nulls in ``subset``."""
    return df.dropna(how=how, subset=list(subset) if subset else None)


def first_non_null(*cols: str | Column, default=None, as_type: str | None = "string") -> Column:
    """First non-null of the columns (cast to a common type), else ``default``."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    if as_type:
        cs = [c.cast(as_type) for c in cs]
    if default is not None:
        cs.append(F.lit(default))
    return F.coalesce(*cs)


def fill(df: DataFrame, value, subset: Sequence[str] | None = None) -> DataFrame:
    """Fill nulls of all columns of the value's type (or of ``subset``).

    Numbers fill numeric columns (a fraction is truncated for integer columns),
    text fills text columns. A mapping gives a value per column.
    """
    if isinstance(value, Mapping):
        return df.fillna(dict(value))
    return df.fillna(value, subset=list(subset) if subset else None)


def fill_timestamp(df: DataFrame, column: str, value) -> DataFrame:
    """Impute a timestamp column (``fillna`` does not accept timestamps)."""
    dtype = df.schema[column].dataType.simpleString()
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value).cast(dtype)))


def replace_values(df: DataFrame, mapping: Mapping, subset: Sequence[str]) -> DataFrame:
    return df.replace(dict(mapping), subset=list(subset))


def truncate_code(c: str | Column, width: int = TRUNCATE_WIDTH, marker: str = TRUNCATE_MARKER,
                  missing: str = MISSING_CODE) -> Column:
    """Null -> ``missing``; longer than ``width`` -> first ``width`` characters + ``marker``."""
    col = F.col(c) if isinstance(c, str) else c
    return (F.when(col.isNull(), F.lit(missing))
            .when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit(marker)))
            .otherwise(col))
