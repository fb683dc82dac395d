"""Grouped sorted-stream plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.slices import GapCut, segmented_scan
from ..operators.trajectory import TRAJECTORY_SIZE
from ..sources.fixtures import POSITIONS_SQL, positions
from ..streaming.keyed_stream import trajectories_grouped
from .registry import plan
from .trajectory_plans import TEST_SIZE, _traj_sql


@plan("group_sort", sql=_traj_sql(TEST_SIZE))
def group_sort(spark, sf):
    """Per-vessel time-sorted record streams, consumed by the trajectory cut (size 25)."""
    return trajectories_grouped(positions(spark, sf), size=TEST_SIZE)


@plan("trajectory_groupsort", sql=_traj_sql(TRAJECTORY_SIZE))
def trajectory_groupsort(spark, sf):
    """The whole job in the grouped-stream variant (size 500); equal to trajectory_core."""
    return trajectories_grouped(positions(spark, sf), size=TRAJECTORY_SIZE)


@plan("partition_iterator_job", sql=_traj_sql(TEST_SIZE))
def partition_iterator_job(spark, sf):
    """Trajectories from a look-ahead iterator over secondary-sorted partitions (size 25)."""
    from ..streaming.keyed_stream import trajectories_partition_iterator
    return trajectories_partition_iterator(positions(spark, sf), size=TEST_SIZE)


@plan("trajectory_partition_iterator", sql=_traj_sql(TRAJECTORY_SIZE))
def trajectory_partition_iterator(spark, sf):
    """The whole job in the hash-and-sort partition-iterator variant (size 500)."""
    from ..streaming.keyed_stream import trajectories_partition_iterator
    return trajectories_partition_iterator(positions(spark, sf), size=TRAJECTORY_SIZE)


GAP_HOURS = 12


@plan("trajectory_gap_cut", sql=(
    f"WITH steps AS (SELECT mmsi, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY mmsi ORDER BY ts)) > {GAP_HOURS} * 3600000000 "
    f"THEN 1 ELSE 0 END AS cut FROM ({POSITIONS_SQL})), "
    f"placed AS (SELECT mmsi, ts, 1 + sum(cut) OVER (PARTITION BY mmsi ORDER BY ts) AS trip FROM steps) "
    f"SELECT mmsi, CAST(trip AS BIGINT) AS trip, min(ts) AS start_time, max(ts) AS end_time, count(*) AS n_records FROM placed GROUP BY mmsi, trip"))
def trajectory_gap_cut(spark, sf):
    """State carried over a vessel's sorted records: a new trip after every gap above twelve hours, by a segmented scan over range slices."""
    cut = segmented_scan(positions(spark, sf).select("mmsi", "ts"), ["mmsi"], ["ts"], GapCut("ts", GAP_HOURS * 3_600_000_000, "trip"))
    return cut.groupBy("mmsi", "trip").agg(F.min("ts").alias("start_time"), F.max("ts").alias("end_time"), F.count(F.lit(1)).alias("n_records"))
