"""Co-grouping as two streams a key: real values of both sides, no list of a key's values.

Both sides are tagged and put together, hash-partitioned by key and sorted by (key, side, the side's order): a secondary sort. User code is called once per key that either side has, with
the key and an iterator over each side's rows; the left side's come first, and taking a row of the right one passes over what is left of the left. A task holds a batch.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

_SIDE, _LEFT, _RIGHT = "_g_side", "_g_left", "_g_right"
ROWS_OUT = 10_000

Streams = Callable[[tuple, Iterator[dict], Iterator[dict]], Iterator[tuple]]


def _rows(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, int, dict]]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(n_keys)]
        sides, left, right = (batch.column(n_keys + i).to_pylist() for i in range(3))
        keys = zip(*columns, strict=True) if n_keys else itertools.repeat(())
        for key, side, a, b in zip(keys, sides, left, right, strict=False):
            yield key, side, b if side else a


def _same(key: tuple) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else (v,) for v in key)


def _run(batches, n_keys: int, fn: Streams, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def results():
        for _, group in itertools.groupby(_rows(batches, n_keys), key=lambda r: _same(r[0])):
            first = next(group)
            rows = itertools.chain([first], group)
            waiting: list[dict] = []

            def left(rows=rows, waiting=waiting):
                for _, side, row in rows:
                    if side:
                        waiting.append(row)
                        return
                    yield row

            lefts = left()

            def right(rows=rows, waiting=waiting, lefts=lefts):
                for _ in lefts:
                    pass
                yield from waiting
                for _, _, row in rows:
                    yield row

            rights = right()
            yield from fn(first[0], lefts, rights)
            for _ in rights:                               # what user code has not taken
                pass

    out = results()
    while part := list(itertools.islice(out, ROWS_OUT)):
        columns = zip(*part, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def cogroup_streams(left: DataFrame, right: DataFrame, keys: Sequence[str], fn: Streams, schema: T.StructType | str,
                    left_order: Sequence[str | Column] = (), right_order: Sequence[str | Column] = ()) -> DataFrame:
    """``fn(key, left rows, right rows)`` for every key of either side; what it yields are the result's rows.

    ``keys`` are columns of both sides; rows are dicts of a side's other columns, in its order. Null keys are a key, as are NaN ones.
    """
    keys = list(keys)
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    a_cols, b_cols = [c for c in left.columns if c not in keys], [c for c in right.columns if c not in keys]

    def one(df, side, mine, order):
        packed = F.struct(*mine) if mine else F.struct(F.lit(True).alias("row"))
        rank = [c if isinstance(c, str) else c for c in order]
        return df.select(*keys, F.lit(side).alias(_SIDE), packed.alias(_RIGHT if side else _LEFT), F.struct(*rank).alias("_g_order") if rank else
                         F.lit(None).alias("_g_order"))
    a, b = one(left, 0, a_cols, left_order), one(right, 1, b_cols, right_order)
    both = (a.withColumnRenamed("_g_order", "_g_o0").unionByName(b.withColumnRenamed("_g_order", "_g_o1"), allowMissingColumns=True)
            .repartition(*keys).sortWithinPartitions(*keys, _SIDE, "_g_o0", "_g_o1").select(*keys, _SIDE, _LEFT, _RIGHT))
    arrow = to_arrow_schema(schema)
    n = len(keys)
    return both.mapInArrow(lambda it: _run(it, n, fn, arrow), schema)
