"""Decomposable user aggregates: zero / update / merge / finish.

Spark runs user aggregates fastest when the *update* step is vectorised and
the *merge* step runs in the JVM. A :class:`DecomposableAggregate` is declared
by:

* ``buffer`` - the buffer fields and their Spark types;
* ``update`` - pandas code that folds one Arrow batch into per-group buffers
  (``DataFrame.groupby(keys)``: vectorised, runs in the map task, so at most
  one buffer per (batch, group) crosses the shuffle);
* ``merge`` - per buffer field, the Spark aggregate that combines buffers
  (``"sum"``, ``"min"``, ``"max"``), run as partial + final hash aggregation;
* ``finish`` - a Column expression over the merged buffer fields.

``aggregate(df, keys, udaf)`` builds ``mapInArrow`` (update) ->
``groupBy(keys).agg(merge)`` -> ``select(finish)``. A hot key costs one buffer
per batch, never a whole group in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# integer columns keep their type beside nulls (plain pandas would turn them into floats)
_EXACT = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype()}
_MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class DecomposableAggregate:
    name: str
    inputs: tuple[str, ...]
    buffer: tuple[tuple[str, str], ...]
    update: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    merge: dict[str, str]
    finish: Callable[..., Column]
    result_type: str = "double"


def _group(pdf: pd.DataFrame, keys: list[str]):
    if keys:
        return pdf.groupby(keys, dropna=False, sort=False)
    return pdf.groupby(pd.Series(0, index=pdf.index), sort=False)


def _frame(parts: dict[str, pd.Series], keys: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(parts)
    return out.reset_index() if keys else out.reset_index(drop=True)


def aggregate(df: DataFrame, keys: Sequence[str], udaf: DecomposableAggregate,
              alias: str | None = None, combine_rows: int = 200_000) -> DataFrame:
    """Run ``udaf`` per group of ``keys`` (all rows when ``keys`` is empty).

    Inside each map task, partial buffers of successive batches are merged with the
    declared merge operations while at most ``combine_rows`` buffer rows are held;
    a larger buffer table is emitted and a new one started, so memory per task stays
    bounded and a key costs at most one buffer per flush.
    """
    keys = list(keys)
    inputs = list(udaf.inputs)
    src = df.select(*keys, *[c for c in inputs if c not in keys])
    key_fields = [src.schema[k] for k in keys]
    buf_schema = T.StructType(key_fields + [T.StructField(n, T._parse_datatype_string(t), True)
                                            for n, t in udaf.buffer])
    buf_names = [n for n, _ in udaf.buffer]
    update = udaf.update          # only these plain values are shipped to the tasks
    merge_ops = {n: udaf.merge[n] for n in buf_names}

    def combine(frames):
        allp = pd.concat(frames, ignore_index=True)
        g = _group(allp, keys)
        merged = pd.DataFrame({n: getattr(g[n], op)(min_count=1) if op == "sum" else getattr(g[n], op)()
                               for n, op in merge_ops.items()})
        return merged.reset_index()[keys + buf_names] if keys else merged.reset_index(drop=True)

    def frame(batch):
        table = pa.Table.from_batches([batch])
        exact = table.select(keys).to_pandas(types_mapper=_EXACT.get)
        return pd.concat([exact, table.select([c for c in table.column_names if c not in keys]).to_pandas()], axis=1)

    def shipped(frames):
        return pa.RecordBatch.from_pandas(frames, schema=arrow_schema, preserve_index=False)

    def partial(batches):
        held, held_rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = update(frame(batch), keys)[keys + buf_names]
            held.append(part)
            held_rows += len(part)
            if len(held) > 1 and held_rows > combine_rows:
                merged = combine(held)
                if len(merged) > combine_rows:
                    yield shipped(merged)
                    held, held_rows = [], 0
                else:
                    held, held_rows = [merged], len(merged)
        if held:
            yield shipped(combine(held) if len(held) > 1 else held[0])

    arrow_schema = to_arrow_schema(buf_schema)
    partials = src.mapInArrow(partial, buf_schema)
    merged = partials.groupBy(*keys).agg(*[_MERGE[udaf.merge[n]](n).alias(n) for n in buf_names])
    result = udaf.finish(*[F.col(n) for n in buf_names]).cast(udaf.result_type)
    return merged.select(*keys, result.alias(alias or udaf.name))


def mean_of(column: str) -> DecomposableAggregate:
    """A user-defined mean: buffer (sum, count); nulls are skipped; an empty or
    all-null group gives null (like ``avg``)."""
    def update(pdf, keys):
        g = _group(pdf, keys)[column]
        return _frame({"sum": g.sum(min_count=1).astype("float64"),
                       "count": g.count().astype("int64")}, keys)

    return DecomposableAggregate(
        name="mean", inputs=(column,), buffer=(("sum", "double"), ("count", "long")),
        update=update, merge={"sum": "sum", "count": "sum"},
        finish=lambda s, n: F.when(n > 0, s / n))


def weighted_mean_of(value: str, weight: str) -> DecomposableAggregate:
    """Mean of ``value`` weighted by ``weight`` (several input columns per row);
    rows where either is null are skipped."""
    def update(pdf, keys):
        ok = pdf[[value, weight]].notna().all(axis=1)
        frame = pdf.assign(_wv=(pdf[value].astype("float64") * pdf[weight].astype("float64")).where(ok),
                           _w=pdf[weight].astype("float64").where(ok))
        g = _group(frame, keys)
        return _frame({"wsum": g["_wv"].sum(), "weight": g["_w"].sum()}, keys)

    return DecomposableAggregate(
        name="weighted_avg", inputs=(value, weight), buffer=(("wsum", "double"), ("weight", "double")),
        update=update, merge={"wsum": "sum", "weight": "sum"},
        finish=lambda s, w: F.when(w != 0, s / w))


def fold_of(column: str, op: str = "sum", zero: float = 0.0) -> DecomposableAggregate:
    """``aggregateByKey(zero)(op, op)`` / ``foldByKey(zero)(op)`` for an associative
    numeric ``op`` in {sum, min, max}. ``zero`` is applied once per key (Spark's
    RDD form applies it once per partition, which only agrees for an identity)."""
    def update(pdf, keys):
        return _frame({"acc": getattr(_group(pdf, keys)[column], op)().astype("float64")}, keys)

    zero_lit = F.lit(float(zero))
    finish = {"sum": lambda a: a + zero_lit,
              "min": lambda a: F.least(a, zero_lit),
              "max": lambda a: F.greatest(a, zero_lit)}[op]
    return DecomposableAggregate(name=f"fold_{op}", inputs=(column,), buffer=(("acc", "double"),),
                                 update=update, merge={"acc": op}, finish=finish)
