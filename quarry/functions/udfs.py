"""User functions: vectorised where Python is needed at all.

The native Column form of each function is preferred; these show the Arrow
paths (``pandas_udf``, Arrow-optimised ``udf``) for logic that really lives
in Python. Integer inputs are cast to double first: a Python UDF declared
``double`` that returns an int yields null.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import DISCOUNT_FACTOR, DISCOUNT_MIN_QUANTITY


@F.pandas_udf(T.DoubleType())
def cube_vec(x: pd.Series) -> pd.Series:
    """Cube of a number, one Arrow batch at a time."""
    return x.astype("float64") ** 3


def cube_of(x: float | None) -> float | None:
    return None if x is None else x * x * x


def cube_udf():
    """An existing Python function as an Arrow-optimised UDF."""
    return F.udf(cube_of, T.DoubleType(), useArrow=True)


def register_cube(spark: SparkSession, name: str = "cube_of") -> None:
    """Make ``cube_of`` callable from SQL text: a SQL function (inlined by Catalyst, no
    Python) rather than a Python UDF."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE) RETURNS DOUBLE RETURN x * x * x")


def register_cube_python(spark: SparkSession, name: str = "cube_py") -> None:
    spark.udf.register(name, cube_udf())


@F.pandas_udf(T.DoubleType())
def discount_vec(quantity: pd.Series, price: pd.Series) -> pd.Series:
    """Two-column UDF: 10 % off from 6 items on."""
    p = price.astype("float64")
    return p.where(quantity < DISCOUNT_MIN_QUANTITY, p * DISCOUNT_FACTOR)


@F.pandas_udf(T.DoubleType())
def discount_row_vec(rec: pd.DataFrame) -> pd.Series:
    """UDF over a struct of the needed columns (never the whole row)."""
    p = rec["p_retailprice"].astype("float64")
    return p.where(rec["l_quantity"] < DISCOUNT_MIN_QUANTITY, p * DISCOUNT_FACTOR)


def discount_on_struct(quantity: str = "l_quantity", price: str = "p_retailprice") -> Column:
    return discount_row_vec(F.struct(F.col(quantity).alias("l_quantity"), F.col(price).alias("p_retailprice")))
