"""Partition control and per-partition processing.

Layout operators are exposed with a checkable result: the partition id of
each row (``spark_partition_id``) can be published and tested (e.g. "each key
lives in exactly one partition").
"""

from __future__ import annotations

import contextlib
import itertools
import subprocess
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..fixed import PARTITION_TAG_SEPARATOR


def num_partitions(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def repartition_n(df: DataFrame, n: int) -> DataFrame:
    """Round-robin into ``n`` partitions (full shuffle)."""
    return df.repartition(n)


def repartition_by(df: DataFrame, *exprs: Column | str, n: int | None = None) -> DataFrame:
    """Hash partition by expressions; without ``n`` the session's shuffle partition
    count applies (AQE may coalesce small ones)."""
    return df.repartition(n, *exprs) if n else df.repartition(*exprs)


def repartition_by_range(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Range partition by sampled bounds into at most ``n`` partitions."""
    return df.repartitionByRange(n, *order)


def coalesce_n(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a full shuffle."""
    return df.coalesce(n)


def with_partition_id(df: DataFrame, name: str = "pid") -> DataFrame:
    return df.withColumn(name, F.spark_partition_id())


def nonempty_partitions(df: DataFrame) -> DataFrame:
    """Number of partitions that hold at least one row."""
    return df.select(F.spark_partition_id().alias("pid")).distinct().agg(F.count(F.lit(1)).alias("nonempty"))


def key_partition_spread(df: DataFrame, key: str | Column, name: str = "n_partitions") -> DataFrame:
    """Per key, in how many partitions its rows lie (1 for key partitioning)."""
    k = F.col(key) if isinstance(key, str) else key
    return (df.withColumn("_pid", F.spark_partition_id())
            .groupBy(k).agg(F.count_distinct("_pid").alias(name)))


def isolate_hot_key(df: DataFrame, key: str, hot_value, n_rest: int, spread_cols: Iterable[str],
                    n_hot: int = 1) -> DataFrame:
    """Custom partitioning: rows with ``key == hot_value`` (null-safe) alone in the first ``n_hot``
    partitions, all others in the ``n_rest`` after them, both spread by a hash of ``spread_cols``.
    A hash instead of a random number keeps the layout stable under task retries."""
    hot, spread = F.col(key).eqNullSafe(F.lit(hot_value)), F.xxhash64(*spread_cols)
    pid = F.when(hot, F.pmod(spread, F.lit(n_hot))).otherwise(F.lit(n_hot) + F.pmod(spread, F.lit(n_rest)))
    return df.repartitionById(n_hot + n_rest, pid.cast("int"))


def partition_counts(df: DataFrame) -> DataFrame:
    """Rows per partition that holds any."""
    return df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))


def tag_with_partition(c: str | Column, sep: str = PARTITION_TAG_SEPARATOR) -> Column:
    """Prefix a value with its partition number."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.spark_partition_id().cast("string"), F.lit(sep), col.cast("string"))


def glom(df: DataFrame, name: str = "rows") -> DataFrame:
    """Each partition as one array of row structs, computed inside the partition without a shuffle.

    The array holds the whole partition by definition: give it partitions that fit a task's memory.
    """
    schema = T.StructType([T.StructField("pid", T.IntegerType()),
                           T.StructField(name, T.ArrayType(T.StructType(df.schema.fields)))])
    kind = to_arrow_schema(df.schema)

    def per_partition(batches):
        from pyspark import TaskContext
        held = [b.to_struct_array() for b in batches]
        structs = pa.concat_arrays(held) if held else pa.array([], pa.struct(list(kind)))
        lists = pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), lists], names=["pid", name])

    return df.mapInArrow(per_partition, schema)


def foreach_partition(df: DataFrame, fn: Callable[[Iterable], None]) -> None:
    """Run a side effect once per partition (an action)."""
    df.foreachPartition(fn)


def pipe_partitions(df: DataFrame, column: str, command: list[str]) -> DataFrame:
    """Feed each partition's values of ``column`` (one per line) to ``command``;
    its stdout lines become the rows of a one-column (``line``) result.

    Runs once per partition, also for an empty one (as ``RDD.pipe`` does). Input is
    written from a thread while the output is read in pieces, so neither pipe can
    block and neither side is held whole; an error of either side fails the task.
    """
    def run(batches):
        import threading
        proc = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE)
        failed = []

        def feed():
            try:
                for b in batches:
                    vals = b.column(0).to_pylist()
                    if vals:
                        proc.stdin.write(("\n".join("" if v is None else v for v in vals) + "\n").encode())
            except BrokenPipeError:      # the command stopped reading; its exit code tells why
                pass
            except Exception as e:  # noqa: BLE001  handed to the reading side
                failed.append(e)
            finally:
                with contextlib.suppress(BrokenPipeError):
                    proc.stdin.close()

        writer = threading.Thread(target=feed)
        writer.start()
        lines = (ln.decode().rstrip("\n") for ln in proc.stdout)
        while part := list(itertools.islice(lines, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string())], names=["line"])
        writer.join()
        if failed:
            raise failed[0]
        if proc.wait() != 0:
            raise RuntimeError(f"{command} failed with exit code {proc.returncode}")

    return df.select(F.col(column).cast("string")).mapInArrow(run, "line string")


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the iterator of a partition's Arrow batches, once a partition, empty ones included; the tuples that it yields are the result's rows."""
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)

    def run(batches):
        rows = fn(batches)
        while part := list(itertools.islice(rows, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*part, strict=True), arrow, strict=True)], schema=arrow)
    return df.mapInArrow(run, fields)
