"""What the operators of this subpackage share: tables, the shared scratch folder, the registry."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Words of the near-duplicate and quality operators: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query, with its DuckDB SQL where SQL can state it."""
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, lineage cut,
    and still there after executors are lost."""
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of ``BATCH_BYTES``, unless the session says how many bytes: by Spark's own setting 10,000 whole
    texts are one batch, which JVM and worker hold at once. Larger buffers also stay longer in the memory that the JVM's C library keeps."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def by_volume(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` (text, binary or list) holds about ``limit`` units in each.

    A single value above the limit is a batch of its own. What is cut off has its own memory, so that a batch from Spark is gone
    before the next one is read. At the end, the worker's freed memory goes back.
    """
    import pyarrow.compute as pc
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        kind = col.type
        length = pc.list_value_length(col) if pa.types.is_list(kind) else pc.binary_length(col)
        total, start = 0, 0
        for k, n in enumerate(length.to_pylist()):
            n = n or 0
            if total and total + n > limit:
                yield _own(batch.slice(start, k - start))
                total, start = 0, k
            total += n
        rest = _own(batch.slice(start)) if batch.num_rows > start else None
        batch = col = length = None
        if rest is not None:
            yield rest
        rest = None
    _give_back()             # the worker idles while stages without Python run


def _own(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A copy that does not hold the batch it is cut from."""
    return batch.take(pa.array(range(batch.num_rows), pa.int64()))


_filled: list[dict] = []


def _give_back() -> None:
    """Memory that this process has freed goes back to the system (Arrow's pool, and glibc's heap where there is one)."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def claim(cache: dict) -> dict:
    """At the start of a task: makes ``cache`` the only filled cache of this worker process, which Spark keeps from
    stage to stage, and gives back what earlier tasks have freed."""
    for other in _filled:
        if other is not cache:
            other.clear()
    _filled[:] = [cache]
    _give_back()
    return cache


def words_of(text) -> F.Column:
    """The words of a text column, ASCII white space cut; null gives an empty array."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
