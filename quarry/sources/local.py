"""Driver-side values as distributed tables.

Only for small, bounded inputs (lookup tables, parameters, test fixtures):
the values travel from the driver inside the plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def from_local(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str,
               num_partitions: int | None = None) -> DataFrame:
    """Local rows with an explicit schema, optionally spread over ``num_partitions``."""
    df = spark.createDataFrame(list(rows), schema)
    return df.repartition(num_partitions) if num_partitions else df


def from_records(spark: SparkSession, records: Iterable[dict], schema: T.StructType) -> DataFrame:
    """Local records (name -> value) with named, typed columns."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


def id_range(spark: SparkSession, start: int, end: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """Generated ``id`` column (``spark.range``), computed in the executors."""
    if end is None:
        return spark.range(start) if num_partitions is None else spark.range(0, start, 1, num_partitions)
    return spark.range(start, end, 1, num_partitions)


def ids_up_to(counted: DataFrame, n: str, chunk: int = 1 << 20) -> DataFrame:
    """``id`` 0..n-1 with ``n`` a column of the one-row ``counted``: a lazy range. The row becomes one row
    per chunk, which are dealt out and expanded in parallel."""
    chunks = counted.where(F.col(n) > 0).select(F.col(n).alias("n"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / chunk))).alias("k"))
    return chunks.repartition("k").select(F.explode(F.sequence(
        F.col("k") * chunk, F.least((F.col("k") + 1) * chunk, F.col("n")) - 1)).alias("id"))
