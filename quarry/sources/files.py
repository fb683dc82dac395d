"""File sources and sinks.

Files are written under the shared checkpoint folder the cluster names in
``spark.checkpoint.dir`` (never a machine-local temporary folder), in a fresh
sub-folder per call.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import POSITION_TIME_FORMAT as AIS_TIME_FORMAT
from ..session import checkpoint_dir

# Full microsecond precision for timestamps in CSV (Spark's default keeps milliseconds).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
AIS_SCHEMA = T.StructType([
    T.StructField("mmsi", T.IntegerType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-files/{name}-{uuid.uuid4().hex}"


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False, rebalance: bool = False) -> DataFrame:
    """CSV with a header; an explicit schema avoids the extra inference pass over the data.

    ``path`` may be a glob (``dir/*.csv``) or a list. Compressed files (``.gz``) are
    not splittable: each is read by one task; ``rebalance`` deals the rows out after the
    read, into partitions of the size that AQE advises.
    """
    reader = (spark.read.option("header", header).option("timestampNTZFormat", TS_FORMAT)
              .option("timestampFormat", TS_FORMAT))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    return df.hint("rebalance") if rebalance else df


def write_csv(df: DataFrame, path: str, header: bool = False, compression: str | None = None,
              single_file: bool = False) -> str:
    """Overwrite a CSV folder. Written in parallel by default; ``single_file`` funnels
    all rows through one task (only for small results)."""
    out = df.coalesce(1) if single_file else df
    w = (out.write.mode("overwrite").option("header", header)
         .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


def ingest_positions(raw: DataFrame, time_format: str = AIS_TIME_FORMAT) -> tuple[DataFrame, DataFrame]:
    """Raw position rows -> (typed records, rejects).

    Keeps ``mmsi``, parses ``timestamp`` with ``time_format``, renames
    latitude/longitude to lat/lon. Rows with an unparsable time or a missing
    vessel/coordinate go to the rejects instead of failing the job.
    """
    parsed = raw.select(F.col("mmsi").cast("int").alias("mmsi"),
                        F.try_to_timestamp(F.col("timestamp"), F.lit(time_format)).cast("timestamp_ntz").alias("ts"),
                        F.col("latitude").cast("double").alias("lat"),
                        F.col("longitude").cast("double").alias("lon"),
                        F.col("timestamp").alias("_raw_time"))
    ok = F.col("mmsi").isNotNull() & F.col("ts").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    good = parsed.where(ok).drop("_raw_time")
    rejects = parsed.where(~ok)
    return good, rejects


def typed_view(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Enforce a record schema: cast each field by name, then check names/types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]).to(schema)
