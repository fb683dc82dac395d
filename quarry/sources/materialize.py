"""Caching, checkpointing, fetching and schema description."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import checkpoint_dir


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for reuse inside the block (spills to disk instead of recomputing)."""
    p = df.persist(level)
    try:
        yield p
    finally:
        p.unpersist()


def checkpointed(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut the lineage by writing ``df`` to the shared checkpoint folder.

    Reliable checkpoints survive executor loss (unlike local checkpoints).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def fetch(df: DataFrame, n: int, *order) -> list:
    """First ``n`` rows under a total order, to the driver (bounded by ``n``)."""
    return (df.orderBy(*order) if order else df).limit(n).collect()


def iterate(df: DataFrame):
    """All rows one partition at a time (driver memory bounded by a partition)."""
    return df.toLocalIterator(prefetchPartitions=True)


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as a table ``(name, type, nullable)`` (metadata only, no job)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("name", T.StringType()), T.StructField("type", T.StringType()),
        T.StructField("nullable", T.BooleanType())]))
