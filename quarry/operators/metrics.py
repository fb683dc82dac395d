"""Side metrics as rows of the same pass."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def with_metric_rows(df: DataFrame, metrics: Mapping[str, Column], name: str = "metric") -> DataFrame:
    """``df``'s rows, and one more per partition that holds the sums of ``metrics`` over it in the struct ``name`` (its other columns null; the struct is null in
    ``df``'s own rows).

    One pass gives both outputs, and nothing runs while it is built. The metric rows are part of a task's output, so that they count as often as its rows do:
    once, however many attempts it takes, which an accumulator does not promise. Metrics are integers, computed in the JVM; a null adds nothing, a partition without a value
    gives null. A sum beyond 64 bits fails the query.
    """
    if name in df.columns:
        raise ValueError(f"with_metric_rows: there is a column {name}")
    own = len(df.columns)
    added = df.select("*", *[c.cast("long").alias(f"_metric_{i}") for i, c in enumerate(metrics.values())])
    kind = T.StructType([T.StructField(m, T.LongType()) for m in metrics])
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in df.schema.fields), T.StructField(name, kind)])
    arrow = to_arrow_schema(schema)

    def run(batches):
        sums: list[int | None] = [None] * kind_size
        for batch in batches:
            for i in range(kind_size):
                # halves of 32 bits: a sum of a batch cannot overflow unseen
                column = batch.column(own + i)
                high = pc.sum(pc.shift_right(column, 32)).as_py()
                if high is not None:
                    sums[i] = (sums[i] or 0) + (high << 32) + pc.sum(pc.bit_wise_and(column, 0xFFFFFFFF)).as_py()
            yield pa.RecordBatch.from_arrays([*batch.columns[:own], pa.nulls(batch.num_rows, arrow.field(own).type)], schema=arrow)
        last = pa.array([dict(zip(names, sums, strict=True))], arrow.field(own).type)
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, arrow.field(i).type) for i in range(own)), last], schema=arrow)
    names, kind_size = list(metrics), len(metrics)
    return added.mapInArrow(run, schema)
