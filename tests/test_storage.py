"""The sink that counts every partition once, types with their own storage, and metric rows."""

import datetime as dt
import os
import subprocess
import sys
import textwrap

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import types as Y
from quarry.operators.metrics import with_metric_rows
from quarry.session import ship_package
from quarry.sources import sink

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _files(path):
    return sorted(f for f in os.listdir(path) if f.endswith(".parquet"))


def test_sink_round_trip_replaces_and_keeps_empty(spark, tmp_path):
    ship_package(spark)
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 7).select("id", F.when(F.col("id") % 3 == 0, None).otherwise(F.concat(F.lit("ü"), "id")).alias("t"))
    rows = lambda: sorted(sink.read_once(spark, path, df.schema).collect())
    sink.write_once(df, path)
    assert rows() == sorted(df.collect()) and len(_files(path)) == 7 and sum(m["rows"] for m in sink.manifest(path)) == 1000
    sink.write_once(df.where("id < 10"), path)
    assert len(rows()) == 10
    sink.write_once(df.where("false"), path)
    assert rows() == []


def test_attempts_that_lose_leave_nothing(spark, tmp_path):
    schema = spark.range(1).schema
    writer = sink.OnceWriter(str(tmp_path), schema)
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3]}, pa.schema([pa.field("id", pa.int64(), False)]))
    lost, won = writer.write(iter([batch])), writer.write(iter([batch, batch]))

    def broken():
        yield batch
        raise RuntimeError("lost executor")
    with pytest.raises(RuntimeError):
        writer.write(broken())
    assert len(_files(tmp_path)) == 3 and lost.file != won.file
    writer.commit([won, None])
    assert _files(tmp_path) == [won.file]
    other = sink.OnceWriter(str(tmp_path), schema)
    other.write(iter([batch]))
    other.abort([])
    assert _files(tmp_path) == [won.file]
    assert sink.read_once(spark, str(tmp_path), schema).count() == 6


def test_failing_first_attempts_and_failed_jobs(tmp_path):
    """A session of its own that retries tasks: every first attempt fails after rows went out; then a job that fails for good."""
    script = textwrap.dedent(f"""
        import sys; sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession
        from quarry.session import ship_package
        from quarry.sources import sink
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        ship_package(spark)
        def flaky(last):
            def run(batches):
                for b in batches:
                    yield b
                if TaskContext.get().attemptNumber() < last:
                    raise RuntimeError("planned")
            return run
        df, path = spark.range(0, 30000, 1, 3), {str(tmp_path / "t")!r}
        sink.write_once(df.mapInArrow(flaky(1), df.schema), path)
        back = sink.read_once(spark, path, df.schema)
        print("ROWS", back.count(), back.distinct().count())
        try:
            sink.write_once(df.mapInArrow(flaky(9), df.schema), path)
        except Exception:
            print("FAILED", sink.read_once(spark, path, df.schema).count())
        spark.stop()
    """)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240, check=True).stdout
    assert "ROWS 30000 30000" in out and "FAILED 30000" in out
    assert len(_files(tmp_path / "t")) == 3


def test_types_are_restored_from_storage(spark, tmp_path):
    ship_package(spark)
    times = [dt.datetime(2024, 2, 29, 23, 59, 59, 999_999), dt.datetime(1969, 12, 31, 23, 59, 59, 999_500), None]
    df = spark.createDataFrame(list(enumerate(times)), "i int, t timestamp_ntz").select(
        "i", Y.instant("t").alias("t"), Y.opaque("i").alias("o"))
    df.write.parquet(str(tmp_path / "x"))
    back = spark.read.parquet(str(tmp_path / "x"))
    assert back.schema["t"].dataType == Y.InstantType() and back.schema["o"].dataType == Y.OpaqueType()
    got = back.orderBy("i").collect()
    assert [r.t for r in got] == [dt.datetime(2024, 2, 29, 23, 59, 59, 999_000), dt.datetime(1969, 12, 31, 23, 59, 59, 999_000), None]
    assert [r.o for r in got] == [Y.Opaque({"i": i}) for i in range(3)]
    assert [r.s for r in back.orderBy("i").select(Y.stored_millis("t").alias("s")).collect()] == [1709251199999, -1, None]
    assert back.where("i = 1").select(Y.restored_field("o", "missing", "int").alias("m")).first().m is None


def test_metric_rows_of_every_partition(spark):
    df = spark.range(0, 100, 1, 6).select("id", F.lit("x").alias("s"))
    big = F.when(F.col("id") < 3, F.lit(2**61)).when(F.col("id") > 97, F.lit(-(2**61)))
    seen = with_metric_rows(df, {"n": F.lit(1), "big": big, "none": F.lit(None)})
    own, last = seen.where("metric IS NULL").drop("metric"), seen.where("metric IS NOT NULL")
    assert sorted(own.collect()) == sorted(df.collect()) and last.count() == 6
    assert last.agg(F.sum("metric.n"), F.sum("metric.big"), F.sum("metric.none"), F.count("id"), F.count("s")).first() == (100, 2**61, None, 0, 0)
    with pytest.raises(ValueError):
        with_metric_rows(df.withColumn("metric", F.lit(1)), {})
