"""Per-key sorted streams with bounded memory.

Two forms, for two kinds of function:

* :func:`fold_sorted_groups` hands user code the records of a key in order, as
  a stream of Arrow tables with a *state* that it returns and gets back. The
  result depends on the order of the records alone, not on how the stream is
  cut. A key is one stream on one task, however large: memory is bounded by a
  batch, time is not shared out.
* :func:`map_sorted_slices` cuts a key into slices on many tasks. It is for
  functions that need no more than the position of a record in its key
  (``offset`` + row number): what a function remembers ends with its slice.
  Rows are counted per (key, bucket) with an order-preserving bucket; running
  sums of the counts give each bucket its offset inside the key, and
  consecutive buckets are merged into slices of about ``target_rows`` rows.

The trajectory cut needs positions only, so it runs in slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import _null_safe_join, time_bucket
from ..operators.trajectory import TRAJECTORY_SIZE

_B, _OFF, _SL = "_s_bucket", "_s_offset", "_s_slice"


def _run_starts(*columns: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Where rows sorted by the columns begin a new run of equal values (null equals null).

    Values are compared as dictionary codes, so integer keys beside a null stay exact.
    """
    n = len(columns[0])
    starts = np.zeros(n, dtype=bool)
    starts[:1] = True
    for col in columns:
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        codes = pc.dictionary_encode(col, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        starts[1:] |= codes[1:] != codes[:-1]
    return starts


def fold_sorted_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       step: Callable[[object, pa.Table], tuple[object, pa.Table]], schema: T.StructType | str,
                       initial: object = None, num_partitions: int | None = None) -> DataFrame:
    """Run ``step(state, rows) -> (state, result rows)`` over each key's records in ascending ``order``.

    ``state`` is ``initial`` at a key's first rows and what the call before returned
    at its next ones; ``rows`` are consecutive records of one key, as many as an
    Arrow batch happens to hold, so ``step`` must not care where they are cut.
    Records are hash-partitioned by key and sorted within partitions (a secondary
    sort): one shuffle, no group in memory.
    """
    keys, order = list(keys), list(order)
    parts = df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, initial
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            firsts = np.flatnonzero(_run_starts(*[table.column(k) for k in keys])) if keys else np.array([0])
            for lo, hi in zip(firsts, [*firsts[1:], table.num_rows], strict=True):
                key = tuple(table.column(k)[int(lo)].as_py() for k in keys)
                if key != current:
                    current, state = key, initial
                state, out = step(state, table.slice(int(lo), int(hi - lo)))
                yield from out.to_batches()

    return parts.sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def map_sorted_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                      fn: Callable[[pa.Table, int], pa.Table], schema: T.StructType | str,
                      target_rows: int = 200_000) -> DataFrame:
    """Call ``fn(rows_sorted_by_order, offset)`` once per (key, slice).

    ``bucket`` must be monotone non-decreasing in ``order`` inside a key; ``offset``
    is the count of the key's rows in earlier slices, so ``offset + i`` is the
    position of the i-th row (0-based) of the slice within its key. A function of
    the position alone gives the same rows for any ``target_rows``; one that
    remembers earlier records does not - use :func:`fold_sorted_groups`.
    """
    keys, order = list(keys), list(order)
    joined = _bucket_offsets(df, keys, bucket, target_rows)
    data_cols = list(df.columns)

    def per_group(tbl):
        offset = pc.min(tbl.column(_OFF)).as_py()       # the slice's first bucket starts here
        idx = pc.sort_indices(tbl, sort_keys=[(c, "ascending") for c in order], null_placement="at_start")
        return fn(tbl.select(data_cols).take(idx), int(offset))

    return joined.groupBy(*keys, _SL).applyInArrow(per_group, schema)


_CUT_FIELDS = ["mmsi", "chunk", "start_time", "end_time", "record_count"]


def _cut_sorted(keys: pa.Array, ts: pa.Array, pos0: np.ndarray, size: int) -> pa.Table:
    """Partial trajectories of rows sorted by (key, ts): one row per run of equal
    (key, chunk), with chunk = 0-based position // size. Runs are contiguous, so
    start/end are the first/last times of each run; null times sort first, so the
    start is the run's first time that is not null."""
    n, chunk = len(pos0), pos0 // size
    first = np.flatnonzero(_run_starts(keys, pa.array(chunk)))
    last = np.append(first[1:] - 1, n - 1)[:len(first)]
    present = pc.is_valid(ts).to_numpy(zero_copy_only=False)
    next_present = np.minimum.accumulate(np.where(present, np.arange(n), n)[::-1])[::-1]
    begin = next_present[first]
    begin = pa.array(begin, pa.int64(), mask=begin > last)
    return pa.table([keys.take(pa.array(first)), pa.array(chunk[first]), ts.take(begin), ts.take(pa.array(last)),
                     pa.array(last - first + 1)], names=_CUT_FIELDS)


def _combined(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _cut_schema(src: DataFrame) -> T.StructType:
    kinds = [src.schema["mmsi"].dataType, T.LongType(), src.schema["ts"].dataType, src.schema["ts"].dataType, T.LongType()]
    return T.StructType([T.StructField(f, k) for f, k in zip(_CUT_FIELDS, kinds, strict=True)])


def _merged(partial: DataFrame) -> DataFrame:
    return (partial.groupBy("mmsi", "chunk")
            .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
                 F.sum("record_count").cast("int").alias("record_count"))
            .drop("chunk"))


def trajectories_grouped(pos: DataFrame, key: str = "mmsi", ts: str = "ts", size: int = TRAJECTORY_SIZE,
                         bucket_seconds: int = 60, target_rows: int = 200_000) -> DataFrame:
    """Trajectory cutting on the per-key sorted stream; same result as
    :func:`quarry.operators.trajectory.build_trajectories`."""
    src = pos.select(F.col(key).alias("mmsi"), F.col(ts).alias("ts"))

    def cut(rows: pa.Table, offset: int) -> pa.Table:
        return _cut_sorted(_combined(rows.column("mmsi")), _combined(rows.column("ts")),
                           offset + np.arange(rows.num_rows, dtype=np.int64), size)

    return _merged(map_sorted_slices(src, ["mmsi"], ["ts"], time_bucket("ts", bucket_seconds), cut,
                                     _cut_schema(src), target_rows))


def _bucket_offsets(src: DataFrame, keys: Sequence[str], bucket: Column, target_rows: int) -> DataFrame:
    """Rows with their bucket, the bucket's offset inside the key and the slice id."""
    keys = list(keys)
    b = src.withColumn(_B, bucket)
    counts = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.select(*keys, _B, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF))
               .withColumn(_SL, F.floor(F.col(_OFF) / F.lit(target_rows))))
    return _null_safe_join(b, offsets, keys + [_B])


def trajectories_partition_iterator(pos: DataFrame, key: str = "mmsi", ts: str = "ts",
                                    size: int = TRAJECTORY_SIZE, bucket_seconds: int = 60,
                                    target_rows: int = 200_000, num_partitions: int | None = None) -> DataFrame:
    """Trajectory cutting by a per-partition iterator over sorted records.

    Records are hash-partitioned by (vessel, slice) and sorted within each partition
    by (vessel, bucket, time) - a secondary sort - then one Arrow pass per batch
    numbers the rows of each (vessel, bucket) run from the bucket's offset and emits
    partial trajectories; a run that crosses a batch boundary carries its count.
    The partial rows are merged per (vessel, chunk) by the JVM.
    """
    src = pos.select(F.col(key).alias("mmsi"), F.col(ts).alias("ts"))
    rows = _bucket_offsets(src, ["mmsi"], time_bucket("ts", bucket_seconds), target_rows)
    parts = (rows.repartition(num_partitions, "mmsi", _SL) if num_partitions else rows.repartition("mmsi", _SL))
    ordered = parts.sortWithinPartitions("mmsi", _B, "ts").select("mmsi", "ts", _B, _OFF)

    def per_partition(batches):
        carry, done = None, 0            # the run that the last batch ended in, and its rows so far
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, times, buckets, offsets = batch.columns
            starts = _run_starts(keys, buckets)
            run_id = np.cumsum(starts) - 1
            idx = np.arange(n, dtype=np.int64) - np.flatnonzero(starts)[run_id]
            if carry == (keys[0].as_py(), buckets[0].as_py()):
                idx[run_id == 0] += done
            yield from _cut_sorted(keys, times, offsets.to_numpy(zero_copy_only=False).astype(np.int64) + idx, size).to_batches()
            carry, done = (keys[n - 1].as_py(), buckets[n - 1].as_py()), int(idx[-1]) + 1

    return _merged(ordered.mapInArrow(per_partition, _cut_schema(src)))
