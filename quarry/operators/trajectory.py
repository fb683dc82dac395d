"""Cutting time-ordered movement records into trajectories.

Semantics: per vessel, records sorted by time are cut into consecutive runs
of ``size`` records; the last run of a vessel may be shorter. Each run gives
``(mmsi, start_time, end_time, record_count)``.

Plan: positions inside each vessel come from :func:`ordered_position`: records
are numbered per (vessel, minute) with offsets carried from the earlier
minutes, so no vessel is processed by a single task. The cut is integer arithmetic on that position and the final ``groupBy(vessel, chunk)``
aggregates partially before its small shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed import TRAJECTORY_SIZE
from ..functions import scalars as S
from .sequence import ordered_position, ordered_previous, time_bucket

TRAJECTORY_COLUMNS = ("mmsi", "start_time", "end_time", "record_count")


def epoch_millis(c: str | Column) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ column (session-zone independent)."""
    return S.epoch_millis(c)


def minutes_to_millis(minutes: str | Column) -> Column:
    """Minutes to milliseconds in 64-bit arithmetic (no 32-bit overflow)."""
    col = F.col(minutes) if isinstance(minutes, str) else minutes
    return col.cast("long") * F.lit(60_000)


def chunk_index(df: DataFrame, key: str = "mmsi", ts: str = "ts", size: int = TRAJECTORY_SIZE,
                bucket_seconds: int = 60) -> DataFrame:
    """Add ``pos`` (1-based, per vessel in time order) and ``chunk`` to each record."""
    if size <= 0:
        raise ValueError("trajectory size must be positive")
    numbered = ordered_position(df, [key], [ts], time_bucket(ts, bucket_seconds), "pos")
    return numbered.withColumn("chunk", F.expr(f"(pos - 1) div {int(size)}"))


def build_trajectories(pos: DataFrame, key: str = "mmsi", ts: str = "ts",
                       size: int = TRAJECTORY_SIZE, bucket_seconds: int = 60,
                       with_duration: bool = False, with_times: bool = False) -> DataFrame:
    """Trajectories of at most ``size`` records per vessel, in time order."""
    chunks = chunk_index(pos.select(key, ts), key, ts, size, bucket_seconds)
    aggs = [F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
            F.count(F.lit(1)).cast("int").alias("record_count")]
    if with_times:
        # bounded by `size` elements per trajectory
        aggs.append(F.sort_array(F.collect_list(epoch_millis(ts))).alias("times"))
    out = chunks.groupBy(F.col(key).alias("mmsi"), "chunk").agg(*aggs).drop("chunk")
    if with_duration:
        out = out.withColumn("duration_ms", trajectory_duration("start_time", "end_time"))
    return out


def trajectory_duration(start: str = "start_time", end: str = "end_time") -> Column:
    """End minus start in milliseconds."""
    return epoch_millis(end) - epoch_millis(start)


def time_diffs(pos: DataFrame, key: str = "mmsi", ts: str = "ts",
               bucket_seconds: int = 60) -> DataFrame:
    """Add ``gap_ms``: milliseconds since the vessel's previous record in time order."""
    prev = ordered_previous(pos, [key], ts, time_bucket(ts, bucket_seconds), [ts])
    return prev.withColumn("gap_ms", epoch_millis(ts) - epoch_millis(f"prev_{ts}")).drop(f"prev_{ts}")


def order_violations(pos: DataFrame, key: str = "mmsi", ts: str = "ts", seq: str = "seq",
                     seq_bucket: int = 1 << 20, strict: bool = False) -> DataFrame:
    """Records whose time goes back against the previous record of the same
    vessel in *arrival* order ``seq``: ``(mmsi, seq, ts, prev_ts, gap_ms)``.

    ``strict=True`` makes the query fail on the first such record.
    """
    prev = ordered_previous(pos.select(key, ts, seq), [key], seq,
                            F.floor(F.col(seq) / F.lit(seq_bucket)), [ts])
    gap = epoch_millis(ts) - epoch_millis(f"prev_{ts}")
    bad = prev.withColumn("gap_ms", gap).where(F.col("gap_ms") < 0)
    if strict:
        # a predicate, so that count() and other column-pruning actions run into it, too
        bad = bad.where(F.when(F.col("gap_ms") < 0, F.raise_error(F.concat(
            F.lit("unsorted data for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))).otherwise(F.lit(True)))
    return bad.select(F.col(key).alias("mmsi"), seq, ts, F.col(f"prev_{ts}").alias("prev_ts"), "gap_ms")


def order_check_summary(pos: DataFrame, key: str = "mmsi", ts: str = "ts", seq: str = "seq",
                        seq_bucket: int = 1 << 20) -> DataFrame:
    """Per vessel: number of records and number of steps back in time in arrival order."""
    prev = ordered_previous(pos.select(key, ts, seq), [key], seq,
                            F.floor(F.col(seq) / F.lit(seq_bucket)), [ts])
    back = (epoch_millis(ts) - epoch_millis(f"prev_{ts}")) < 0
    return prev.groupBy(F.col(key).alias("mmsi")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count(F.when(back, F.lit(1))).alias("n_backward"))


def build_trajectories_window(pos: DataFrame, key: str = "mmsi", ts: str = "ts",
                              size: int = TRAJECTORY_SIZE) -> DataFrame:
    """Single-window form (one exchange), for data known to have no hot vessel."""
    w = Window.partitionBy(key).orderBy(ts)
    c = pos.select(key, ts).withColumn("chunk", F.floor((F.row_number().over(w) - 1) / F.lit(size)))
    return c.groupBy(F.col(key).alias("mmsi"), "chunk").agg(
        F.min(ts).alias("start_time"), F.max(ts).alias("end_time"),
        F.count(F.lit(1)).cast("int").alias("record_count")).drop("chunk")
