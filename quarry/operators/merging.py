"""User aggregates with an opaque state and the user's own merge.

:class:`MergeAggregate` is ``zero`` / ``update`` / ``merge`` / ``finish`` over any Python state: what the states are and how two of
them become one is the user's business, so sums, minima and maxima are not the only ones. :func:`merge_aggregate` runs it as

1. update: every task folds its Arrow batches into one state per key, and gives the held states on when there are more than ``held``;
2. merge in ``depth`` levels: states of a key with neighbouring numbers are merged ``fan_in`` at a time, then what is left of a key. Each level
   is one shuffle of states, sorted by (key, number) and merged as a stream: a task holds the state that it is at and the next one, never a group.

A hot key costs one state per flush of a task, and its last merge sees the number of states divided by ``fan_in`` to the power ``depth - 1``. Merges run in
the order of the states' numbers.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..streaming.keyed_stream import _run_starts

_NUMBER, _STATE = "_m_number", "_m_state"
FLUSHES = 1 << 20            # of a task, at most, for the numbers of its states


class MergeAggregate:
    """``inputs`` are the columns that :meth:`update` reads, ``result`` is the DDL type of what :meth:`finish` gives."""

    inputs: Sequence[str] = ()
    result = "double"

    def zero(self):
        raise NotImplementedError

    def update(self, state, rows: pa.Table):
        raise NotImplementedError

    def merge(self, left, right):
        raise NotImplementedError

    def finish(self, state):
        return state


def _groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, its rows) of every batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if keys:
            table = table.take(pc.sort_indices(table, sort_keys=[(k, "ascending") for k in keys]))
        starts = np.flatnonzero(_run_starts(*(table.column(k) for k in keys))) if keys else np.array([0])
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
            yield tuple(table.column(k)[lo].as_py() for k in keys), table.slice(lo, hi - lo)


def _known(key: tuple) -> tuple:
    """A key under which NaN finds NaN."""
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else (v,) for v in key)


def _update(batches, keys: Sequence[str], agg: MergeAggregate, schema: pa.Schema, held: int) -> Iterator[pa.RecordBatch]:
    states: dict[tuple, list] = {}
    first, flushes = TaskContext.get().partitionId() * FLUSHES, 0

    def flush():
        columns = [pa.array([k[i] for k, _ in states.values()], schema.field(i).type) for i in range(len(keys))]
        numbers = pa.array([first + flushes] * len(states), pa.int64())
        return pa.RecordBatch.from_arrays([*columns, numbers, pa.array([pickle.dumps(s) for _, s in states.values()], pa.binary())], schema=schema)
    for key, rows in _groups(batches, keys):
        entry = states.setdefault(_known(key), [key, None])
        entry[1] = agg.update(agg.zero() if entry[1] is None else entry[1], rows)
        if len(states) > held:
            yield flush()
            states.clear()
            flushes += 1
    if states:
        yield flush()


def _merge(batches, keys: Sequence[str], agg: MergeAggregate, schema: pa.Schema, last: bool) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of one (key, number), or of one key on the last level, as one."""
    at = None

    def out(key, number, state):
        values = [pa.array([v], schema.field(i).type) for i, v in enumerate(key)]
        tail = [pa.array([agg.finish(state)], schema.field(len(keys)).type)] if last else [
            pa.array([number], pa.int64()), pa.array([pickle.dumps(state)], pa.binary())]
        return pa.RecordBatch.from_arrays([*values, *tail], schema=schema)

    def merged():
        nonlocal at
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for *key, number, state in zip(*columns, strict=True):
                here = (_known(tuple(key)), None if last else number)
                if at is not None and at[0] == here:
                    at[3] = agg.merge(at[3], pickle.loads(state))
                else:
                    if at is not None:
                        yield out(*at[1:])
                    at = [here, tuple(key), number, pickle.loads(state)]
        if at is not None:
            yield out(*at[1:])
    held: list[pa.RecordBatch] = []
    for row in merged():
        held.append(row)
        if len(held) >= 1000:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def merge_aggregate(df: DataFrame, keys: Sequence[str], agg: MergeAggregate, alias: str, depth: int = 2, fan_in: int = 16,
                    held: int = 20_000) -> DataFrame:
    """``agg`` per group of ``keys`` (all rows without keys): (keys, ``alias``). Null and NaN keys are groups; no rows give no row, but for
    an aggregate without keys, which then is that of ``zero``."""
    if depth < 1 or fan_in < 2:
        raise ValueError("depth is at least 1, fan_in at least 2")
    keys = list(keys)
    src = df.select(*keys, *(c for c in dict.fromkeys(agg.inputs) if c not in keys))
    fields = [src.schema[k] for k in keys]
    states = T.StructType([*fields, T.StructField(_NUMBER, T.LongType()), T.StructField(_STATE, T.BinaryType())])
    result = T.StructType([*fields, T.StructField(alias, T._parse_datatype_string(agg.result))])
    arrow_states, arrow_result = to_arrow_schema(states), to_arrow_schema(result)
    now = src.mapInArrow(lambda it: _update(it, keys, agg, arrow_states, held), states)
    spread = F.col(_NUMBER)
    for level in range(1, depth):
        # tasks' numbers lie far apart: the first level works on task and flush, later ones on what it gave
        spread = F.floor(F.col(_NUMBER) / (F.lit(fan_in) if level > 1 else F.lit(fan_in * FLUSHES))).cast("long")
        now = (now.withColumn(_NUMBER, spread).repartition(*keys, _NUMBER).sortWithinPartitions(*keys, _NUMBER)
               .mapInArrow(lambda it: _merge(it, keys, agg, arrow_states, False), states))
    together = now.repartition(*keys) if keys else now.repartition(1)
    out = together.sortWithinPartitions(*keys, _NUMBER).mapInArrow(lambda it: _merge(it, keys, agg, arrow_result, True), result)
    if keys:
        return out
    empty = df.sparkSession.range(1).mapInArrow(
        lambda it: (pa.RecordBatch.from_arrays([pa.array([agg.finish(agg.zero())], arrow_result.field(0).type)], schema=arrow_result) for _ in it), result)
    return empty if df.isEmpty() else out


class TopK(MergeAggregate):
    """The ``k`` rows with the largest ``value``, ties by ``ties`` ascending, as ``value|tie|...`` texts, best first; rows with a null value are left out,
    null ties come first. The state is a list, its merge a merge of lists."""

    result = "array<string>"

    def __init__(self, k: int, value: str, *ties: str):
        self.k, self.value, self.ties, self.inputs = k, value, ties, (value, *ties)

    @staticmethod
    def _place(row):
        return (-row[0], *((v is not None, v) for v in row[1:]))

    def zero(self):
        return []

    def update(self, state, rows):
        table = rows.filter(pc.is_valid(rows.column(self.value)))
        if table.num_rows > 4 * self.k:                    # the batch's own k-th value bounds what can matter
            cut = pc.min(table.column(self.value).take(pc.select_k_unstable(
                table.column(self.value), options=pc.SelectKOptions(self.k, [("", "descending")]))))
            table = table.filter(pc.greater_equal(table.column(self.value), cut))
        rows = list(zip(*(table.column(c).to_pylist() for c in self.inputs), strict=True))
        return heapq.nsmallest(self.k, [*state, *rows], key=self._place)

    def merge(self, left, right):
        return heapq.nsmallest(self.k, [*left, *right], key=self._place)

    def finish(self, state):
        return ["|".join("" if v is None else str(v) for v in row) for row in state]


class WeightedReservoir(MergeAggregate):
    """A sample of ``k`` values without replacement, with chances by ``weight``: the k largest of u ** (1 / weight), u from a hash of the
    ``ident`` column, so the sample is the same in any layout. Rows with a null or non-positive weight are never drawn."""

    result = "array<string>"

    def __init__(self, k: int, value: str, weight: str, ident: str, seed: int = 0):
        self.k, self.value, self.weight, self.ident, self.seed, self.inputs = k, value, weight, ident, seed, (value, weight, ident)

    def zero(self):
        return []

    def update(self, state, rows):
        found = []
        for value, weight, ident in zip(*(rows.column(c).to_pylist() for c in self.inputs), strict=True):
            if weight is not None and weight > 0:
                u = (int.from_bytes(hashlib.blake2b(f"{self.seed}:{ident}".encode(), digest_size=8).digest(), "big") + 0.5) / 2.0 ** 64
                found.append((math.log(u) / weight, str(ident), value))
        return self.merge(state, found)

    def merge(self, left, right):
        return heapq.nlargest(self.k, [*left, *right], key=lambda r: r[:2])

    def finish(self, state):
        return sorted("" if r[2] is None else str(r[2]) for r in state)
