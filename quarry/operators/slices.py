"""Ordered scans over keys of any size: range slices and an associative state.

A key's records in order, with something carried from record to record, need not go through one task if what is carried can be
combined: the state of ``a`` followed by ``b`` is ``combine(state of a, state of b)``. The scan then runs in three steps:

1. :func:`ordered_slices` range-partitions the rows by (keys, order, hash of the row), so that Spark's sampled boundaries cut through a hot key and
   through its ties, sorts every slice and checkpoints it in the shared folder (both passes must see the same slices);
2. every slice summarises its first and its last key, the only ones that it may share with others: a row per slice goes to the driver, which
   combines them in order into what is carried into each slice;
3. every slice applies the scan to its rows, batch by batch, starting from what is carried into it.

The table of what is carried has one row per slice, however many keys or distinct values there are; the rows are shuffled once. Rows that are equal in all columns
stay in one slice. Checkpoint and summaries run while the plan is built.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import checkpoint_dir
from ..streaming.keyed_stream import _run_starts

_SLICE = "_r_slice"


class Scan:
    """What a scan adds to rows, and the state that it carries.

    ``columns`` are the (name, type) of the added columns. :meth:`summarise` gives the state of consecutive rows of one key, :meth:`combine` that of one stretch
    followed by another, and :meth:`apply` the added columns of consecutive rows, in which keys begin where ``starts`` is true; the first
    of these keys has ``before`` behind it (None: nothing). Results must not depend on how a key's rows are cut.
    """

    columns: Sequence[tuple[str, str]] = ()

    def summarise(self, rows: pa.Table):
        raise NotImplementedError

    def combine(self, left, right):
        raise NotImplementedError

    def apply(self, rows: pa.Table, starts: np.ndarray, before) -> list:
        raise NotImplementedError


def ordered_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int | None = None) -> DataFrame:
    """``df`` in slices of consecutive rows by (keys, order), each sorted, with the slice's number; checkpointed."""
    checkpoint_dir(df.sparkSession)
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = [*(F.col(k).asc_nulls_first() for k in keys), *order, F.xxhash64(*hashed)]
    parts = df.repartitionByRange(slices, *by) if slices else df.repartitionByRange(*by)
    return parts.sortWithinPartitions(*by).withColumn(_SLICE, F.spark_partition_id()).checkpoint()


def _key(table: pa.Table, keys: Sequence[str], row: int) -> tuple:
    """A row's key; NaN equals NaN."""
    values = (table.column(k)[row].as_py() for k in keys)
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else (v,) for v in values)


def _by_slice(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """(slice, consecutive rows of it, where its keys begin among them)."""
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            numbers = table.column(_SLICE).to_numpy()
            edges = np.flatnonzero(np.diff(numbers)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)], strict=True):
                part = table.slice(lo, hi - lo).drop_columns([_SLICE])
                starts = _run_starts(*(part.column(k) for k in keys)) if keys else np.arange(hi - lo) == 0
                yield int(numbers[lo]), part, starts


@dataclass
class _Edge:
    """A slice as others see it: its first and last key with their states; ``one`` if they are the same stretch."""
    first_key: tuple
    first: object
    last_key: tuple
    last: object
    one: bool


def _edges(batches: Iterator[pa.RecordBatch], keys: Sequence[str], scan: Scan) -> Iterator[pa.RecordBatch]:
    found: dict[int, _Edge] = {}
    for number, rows, starts in _by_slice(batches, keys):
        at = np.flatnonzero(starts)
        head = scan.summarise(rows.slice(0, int(at[1]) if len(at) > 1 else rows.num_rows))
        key, edge = _key(rows, keys, 0), found.get(number)
        if edge is None:
            edge = found[number] = _Edge(key, head, key, head, True)
        elif key == edge.last_key:
            edge.last = scan.combine(edge.last, head)
            edge.first = edge.last if edge.one else edge.first
        else:
            edge.last_key, edge.last, edge.one = key, head, False
        if len(at) > 1:
            edge.last_key, edge.last, edge.one = _key(rows, keys, int(at[-1])), scan.summarise(rows.slice(int(at[-1]))), False
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([pickle.dumps(e) for e in found.values()], pa.binary())],
                                         names=["number", "edge"])


def carried(edges: list[tuple[int, _Edge]], scan: Scan) -> dict[int, object]:
    """What is carried into each slice whose first key has rows in slices before it."""
    out: dict[int, object] = {}
    key, state = None, None
    for number, edge in sorted(edges, key=lambda e: e[0]):
        if edge.first_key == key:
            out[number] = state
        if edge.one and edge.first_key == key:
            state = scan.combine(state, edge.last)
        else:
            state = edge.last
        key = edge.last_key
    return out


def _applied(batches: Iterator[pa.RecordBatch], keys: Sequence[str], scan: Scan, carry: dict[int, object]) -> Iterator[pa.RecordBatch]:
    here, key, state = None, None, None
    for number, rows, starts in _by_slice(batches, keys):
        if number != here:
            here, state = number, carry.get(number)
        elif _key(rows, keys, 0) != key:
            state = None
        added = scan.apply(rows, starts, state)
        at = np.flatnonzero(starts)
        tail = scan.summarise(rows.slice(int(at[-1])))
        state = scan.combine(state, tail) if len(at) == 1 and state is not None else tail
        key = _key(rows, keys, rows.num_rows - 1)
        yield from pa.Table.from_arrays([*rows.columns, *added], names=[*rows.column_names, *(n for n, _ in scan.columns)]).to_batches()


def segmented_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], scan: Scan, slices: int | None = None) -> DataFrame:
    """``df`` with the columns of ``scan``, run over each key's rows in ``order``; the result is that of one pass over every key,
    in any number of ``slices``. Null and NaN keys are keys; ties are taken in the order of a hash of the row."""
    keys = list(keys)
    cut = ordered_slices(df, keys, order, slices)
    rows = cut.mapInArrow(lambda it: _edges(it, keys, scan), "number int, edge binary").collect()      # one row a slice
    carry = carried([(r.number, pickle.loads(r.edge)) for r in rows], scan)
    added = [T.StructField(n, T._parse_datatype_string(t)) for n, t in scan.columns]
    return cut.mapInArrow(lambda it: _applied(it, keys, scan, carry), T.StructType([*df.schema.fields, *added]))


class Running(Scan):
    """Running results from a key's first row to the current one: ``items`` are (operation, column, name), the operations ``count`` (of rows,
    column None), ``sum`` and ``max`` (nulls ignored, null before the first value) of integer or floating-point columns."""

    def __init__(self, items: Sequence[tuple[str, str | None, str]], schema: T.StructType):
        self.items = list(items)
        kinds = []
        for op, column, name in self.items:
            kind = schema[column].dataType if column else T.LongType()
            if not isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType)):
                raise TypeError(f"running {op} of {column}: {kind.simpleString()} is neither integer nor floating point")
            wide = T.LongType() if isinstance(kind, T.IntegralType) else T.DoubleType()
            kinds.append((name, (wide if op == "sum" else kind).simpleString()))
        self.columns = kinds
        self.arrow = [to_arrow_type(T._parse_datatype_string(t)) for _, t in kinds]

    @staticmethod
    def _values(rows: pa.Table, column: str) -> pd.Series:
        kind = rows.schema.field(column).type
        exact = pd.Int64Dtype() if pa.types.is_integer(kind) else pd.Float64Dtype()
        values = rows.column(column).cast(pa.int64() if pa.types.is_integer(kind) else pa.float64())
        return values.to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.float64(): pd.Float64Dtype()}.get).astype(exact)

    def summarise(self, rows):
        out = []
        for op, column, _ in self.items:
            if op == "count":
                out.append(rows.num_rows)
            else:
                v = self._values(rows, column)
                total = v.sum(min_count=1) if op == "sum" else v.max()
                out.append(None if total is pd.NA else total.item() if hasattr(total, "item") else total)
        return out

    def combine(self, left, right):
        return [b if a is None else a if b is None else max(a, b) if op == "max" else a + b
                for (op, *_), a, b in zip(self.items, left, right, strict=True)]

    def apply(self, rows, starts, before):
        run = np.cumsum(starts) - 1
        first = run == 0
        out = []
        for k, (op, column, _) in enumerate(self.items):
            behind = before[k] if before else None
            if op == "count":
                at = np.arange(rows.num_rows) - np.flatnonzero(starts)[run] + 1
                out.append(pa.array(at + np.where(first, behind or 0, 0), pa.int64()))
                continue
            by = self._values(rows, column).groupby(run)
            now = (by.cumsum() if op == "sum" else by.cummax()).groupby(run).ffill()
            if behind is not None:
                head = now[first]
                now[first] = head.fillna(0) + behind if op == "sum" else head.fillna(behind).clip(lower=behind)
            out.append(pa.array(now, from_pandas=True).cast(self.arrow[k]))
        return out


class GapCut(Scan):
    """Numbers a key's stretches without a gap above ``gap_micros`` in a timestamp column, from 1. A null time, first in order, begins no stretch."""

    def __init__(self, ts: str, gap_micros: int, name: str = "stretch"):
        self.ts, self.gap, self.columns = ts, gap_micros, [(name, "bigint")]

    def _micros(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        column = rows.column(self.ts).cast(pa.timestamp("us", rows.schema.field(self.ts).type.tz)).cast(pa.int64())
        return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()

    def summarise(self, rows):
        at, there = self._micros(rows)
        at = at[there]
        return (int(at[0]), int(at[-1]), int((np.diff(at) > self.gap).sum())) if len(at) else None, rows.num_rows

    def combine(self, left, right):
        (a, n), (b, m) = left, right
        whole = b if a is None else a if b is None else (a[0], b[1], a[2] + b[2] + (b[0] - a[1] > self.gap))
        return whole, n + m

    def apply(self, rows, starts, before):
        at, there = self._micros(rows)
        cut = np.zeros(len(at), dtype=np.int64)
        cut[1:] = (np.diff(at) > self.gap) & there[1:] & there[:-1] & ~starts[1:]
        run = np.cumsum(starts) - 1
        behind = before[0] if before else None
        if behind and there[0]:
            cut[0] = at[0] - behind[1] > self.gap
        total = np.cumsum(cut)
        base = (total - cut)[np.flatnonzero(starts)]
        base[0] = -(behind[2] if behind else 0)
        return [pa.array(total - base[run] + 1, pa.int64())]


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], items: Sequence[tuple[str, str | None, str]],
            slices: int | None = None) -> DataFrame:
    """``df`` with running results (:class:`Running`) per key in ``order``, ROWS frame from the first row to the current."""
    return segmented_scan(df, keys, order, Running(items, df.schema), slices)


def range_frame_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, lower: int, upper: int, descending: bool = False,
                    name: str = "range_sum", slices: int | None = None) -> DataFrame:
    """``sum(value) OVER (PARTITION BY keys ORDER BY order [DESC] RANGE BETWEEN lower AND upper)`` of integers, keys of any size spread.

    The rows are summed by (keys, order value) first. A value's sum enters the running total of its key where the first frame that holds it
    lies and leaves it behind the last, so the frames are one :func:`running` total over these points, cut into slices like any other. Rows
    get their frame by a join on (keys, order value). Frames of a null order value hold the rows with a null order value.
    """
    if not isinstance(df.schema[value].dataType, T.IntegralType) or not isinstance(df.schema[order].dataType, T.IntegralType):
        raise TypeError("range_frame_sum: order and value are integers; use a window for other types")
    keys = list(keys)
    packed = F.struct(*keys, order)
    sums = df.groupBy(packed.alias("k")).agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    at = F.col(f"k.{order}").cast("long")
    enters, leaves = (at + lower, at + upper) if descending else (at - upper, at - lower)
    group = F.struct(*(F.col(f"k.{k}").alias(k) for k in keys)) if keys else F.struct(F.lit(0).alias("all"))
    points = sums.where(at.isNotNull()).select("k", group.alias("g"), F.inline(F.array(
        F.struct(enters.alias("at"), F.lit(0).alias("kind"), F.col("s").alias("s"), F.col("n").alias("n")),
        F.struct(at.alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("s"), F.lit(0).cast("long").alias("n")),
        F.struct(leaves.alias("at"), F.lit(2).alias("kind"), (-F.col("s")).alias("s"), (-F.col("n")).alias("n")))))
    flat = points.select("k", *[F.col(f"g.{c}").alias(f"g{i}") for i, c in enumerate(keys or ["all"])], "at", "kind", "s", "n")
    groups = [f"g{i}" for i in range(max(len(keys), 1))]
    totals = running(flat, groups, ["at", "kind"], [("sum", "s", "total"), ("sum", "n", "rows")], slices)
    frames = (totals.where("kind = 1").select("k", F.when(F.col("rows") > 0, F.col("total")).alias(name))
              .union(sums.where(at.isNull()).select("k", F.when(F.col("n") > 0, F.col("s")))))
    return df.withColumn("_r_k", packed).join(frames.withColumnRenamed("k", "_r_k"), "_r_k").drop("_r_k")
