"""Access to the driver's Parquet tables.

Reads are lazy: Catalyst prunes columns and pushes filters into the Parquet
scan, so callers select only what they use and filter as early as they like.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose every table as a temp view (for SQL-text operators)."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)
