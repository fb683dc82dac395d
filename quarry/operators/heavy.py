"""Joins whose keys are heavy on both sides.

:func:`heavy_keys` finds them with a frequent-items sketch (``approx_top_k``, merged from map-side partials): no value need be named. :func:`grid_join` lays
the pairs of such a key out as a grid: its left rows are dealt over the grid's rows and repeated in every column, its right rows are dealt over the columns
and repeated in every row, so that each pair of rows meets in exactly one cell. All other keys have a grid of one cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HASH, _ROW, _COL = "_g_hash", "_g_row", "_g_col"
TRACKED = 8             # items that the sketch tracks, for each one that may be heavy
LARGEST = 1_000_000     # items that Spark's sketch can track


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def heavy_keys(df: DataFrame, keys: Sequence[str], cells: int, name: str = "n") -> DataFrame:
    """``(hash of the key, estimated rows, cells)`` of keys without nulls that hold more than one ``cells``-th of the rows: at most ``cells`` rows.

    ``cells`` is the number of grid lines that the key's rows are dealt over. Keys of any types and number are one 64-bit hash here; a collision gives a light
    key a grid of its own, which costs copies and changes no result. The sketch holds a bounded number of items per task.
    """
    if not 1 <= cells <= LARGEST // TRACKED:
        raise ValueError(f"cells must lie between 1 and {LARGEST // TRACKED}")
    hashed = df.where(_whole(keys)).select(_hash(keys).alias(_HASH))
    seen = hashed.agg(F.expr(f"approx_top_k({_HASH}, {cells}, {TRACKED * cells})").alias("top"), F.count(F.lit(1)).alias("rows"))
    each = seen.select(F.explode("top").alias("t"), "rows")
    lines = F.ceil(F.col("t.count") * cells / F.col("rows")).cast("int")
    return each.select(F.col("t.item").alias(_HASH), F.col("t.count").alias(name), lines.alias("lines")).where("lines > 1")


def _whole(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def _dealt(df: DataFrame, keys: Sequence[str], grid: DataFrame, own: str, other: str, mine: str, theirs: str) -> DataFrame:
    """``df`` with its cells: dealt by the hash of the row over its own lines, repeated along the other side's."""
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row = F.xxhash64(F.lit(own), *hashed)
    at = df.where(_whole(keys)).withColumn(_HASH, _hash(keys)).join(F.broadcast(grid), _HASH, "left")
    lines, copies = F.coalesce(F.col(own), F.lit(1)), F.coalesce(F.col(other), F.lit(1))
    return (at.withColumn(mine, F.pmod(row, lines).cast("int"))
            .withColumn(theirs, F.explode(F.sequence(F.lit(0), copies - 1))).drop(_HASH, "_g_left", "_g_right"))


def grid_sides(left: DataFrame, right: DataFrame, on: Sequence[str], cells: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cells; rows with a null key, which an inner join drops, are left out."""
    for k in on:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"grid_join: {k} is {left.schema[k].dataType.simpleString()} on the left, {right.schema[k].dataType.simpleString()} on the right")
    grid = (heavy_keys(left, on, cells).select(_HASH, F.col("lines").alias("_g_left"))
            .join(heavy_keys(right, on, cells).select(_HASH, F.col("lines").alias("_g_right")), _HASH, "full"))
    return (_dealt(left, on, grid, "_g_left", "_g_right", _ROW, _COL), _dealt(right, on, grid, "_g_right", "_g_left", _COL, _ROW))


def grid_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], cells: int | None = None) -> DataFrame:
    """Inner equi join in which no cell holds much more than one ``cells``-th of either side, however hot a key is on both sides.

    ``cells`` defaults to the session's number of shuffle partitions. Nothing runs while the join is built; each side is read once more, its keys only, for its sketch. What is
    broadcast is the table of grids: at most ``2 * cells`` rows of three numbers. A heavy key's row is repeated once per line of the other side's, which is little
    beside the pairs that it makes there. Rows are dealt by the hash of all their columns (but maps), so that a recomputed task deals alike; rows equal in all columns stay
    together. Keys have the same type on both sides; an outer, semi or anti join needs one side's keys only and is left to :func:`quarry.operators.joins.salted_join`.
    """
    keys = [on] if isinstance(on, str) else list(on)
    cells = cells or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a, b = grid_sides(left, right, keys, cells)
    return a.join(b, [*keys, _ROW, _COL]).drop(_ROW, _COL)
