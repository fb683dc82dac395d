"""Trajectory job plans (positions derived from ``events``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import trajectory as T
from ..sources.fixtures import POSITIONS_SQL, positions
from .registry import plan
from .sqlutil import MS

# Chunk size that makes cuts happen at the small scale factors (users have
# 49-86 events at sf0.01); the reference constant 500 is used by the whole job.
TEST_SIZE = 25


def _traj_sql(size: int, extra: str = "") -> str:
    return (
        f"WITH positions AS ({POSITIONS_SQL}), "
        f"numbered AS (SELECT mmsi, ts, (row_number() OVER (PARTITION BY mmsi ORDER BY ts) - 1) // {size} AS chunk "
        f"FROM positions) "
        f"SELECT mmsi, min(ts) AS start_time, max(ts) AS end_time, CAST(count(*) AS INTEGER) AS record_count{extra} "
        f"FROM numbered GROUP BY mmsi, chunk"
    )


@plan("trajectory_build", sql=_traj_sql(TEST_SIZE))
def trajectory_build(spark, sf):
    """Per vessel, time-sorted records cut every 25 records."""
    return T.build_trajectories(positions(spark, sf), size=TEST_SIZE)


@plan("trajectory_core", sql=_traj_sql(T.TRAJECTORY_SIZE))
def trajectory_core(spark, sf):
    """The whole job with the reference size of 500 records."""
    return T.build_trajectories(positions(spark, sf), size=T.TRAJECTORY_SIZE)


@plan("trajectory_duration", sql=(
    f"SELECT *, {MS("end_time")} - {MS("start_time")} AS duration_ms FROM ({_traj_sql(TEST_SIZE)})"))
def trajectory_duration(spark, sf):
    """Trajectories with their duration in milliseconds."""
    return T.build_trajectories(positions(spark, sf), size=TEST_SIZE, with_duration=True)


@plan("trajectory_times", sql=(
    f"WITH positions AS ({POSITIONS_SQL}), "
    f"numbered AS (SELECT mmsi, ts, (row_number() OVER (PARTITION BY mmsi ORDER BY ts) - 1) // {TEST_SIZE} AS chunk "
    f"FROM positions) "
    f"SELECT mmsi, min(ts) AS start_time, max(ts) AS end_time, CAST(count(*) AS INTEGER) AS record_count, "
    f"list_sort(list({MS("ts")})) AS times FROM numbered GROUP BY mmsi, chunk"))
def trajectory_times(spark, sf):
    """Trajectories with the epoch-millisecond times of their records."""
    return T.build_trajectories(positions(spark, sf), size=TEST_SIZE, with_times=True)


@plan("trajectory_time_diff", sql=(
    f"SELECT mmsi, ts, {MS("ts")} - {MS("lag(ts) OVER (PARTITION BY mmsi ORDER BY ts)")} AS gap_ms "
    f"FROM ({POSITIONS_SQL})"))
def trajectory_time_diff(spark, sf):
    """Gap in milliseconds from the vessel's previous record."""
    return T.time_diffs(positions(spark, sf).select("mmsi", "ts"))


@plan("trajectory_order_check", sql=(
    f"SELECT mmsi, count(*) AS n_records, "
    f"count(CASE WHEN {MS("ts")} - {MS("prev_ts")} < 0 THEN 1 END) AS n_backward FROM ("
    f"SELECT mmsi, ts, lag(ts) OVER (PARTITION BY mmsi ORDER BY seq) AS prev_ts FROM ({POSITIONS_SQL})) "
    f"GROUP BY mmsi"))
def trajectory_order_check(spark, sf):
    """Per vessel, steps back in time in arrival (event id) order."""
    return T.order_check_summary(positions(spark, sf))


@plan("trajectory_order_violations", sql=(
    f"SELECT mmsi, seq, ts, prev_ts, {MS("ts")} - {MS("prev_ts")} AS gap_ms FROM ("
    f"SELECT mmsi, seq, ts, lag(ts) OVER (PARTITION BY mmsi ORDER BY seq) AS prev_ts FROM ({POSITIONS_SQL})) "
    f"WHERE {MS("ts")} - {MS("prev_ts")} < 0"))
def trajectory_order_violations(spark, sf):
    """Records that step back in time against their predecessor in arrival order."""
    return T.order_violations(positions(spark, sf))


@plan("minutes_to_millis", sql=(
    "SELECT event_id, CAST(trunc(value) AS BIGINT) * 60000 AS ms FROM events"))
def minutes_to_millis(spark, sf):
    """Minutes (here the rounded event value) to milliseconds in 64-bit arithmetic."""
    from ..sources.tables import read_table
    ev = read_table(spark, sf, "events", "event_id", "value")
    return ev.select("event_id", T.minutes_to_millis(F.col("value").cast("long")).alias("ms"))
