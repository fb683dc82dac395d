"""Source, sink and materialisation plans."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.trajectory import build_trajectories
from ..sources import files, local, sink
from ..sources.fixtures import FLIGHTS_SQL, POSITIONS_SQL, flights, positions
from ..sources.materialize import checkpointed
from ..sources.tables import read_table
from .registry import plan
from .trajectory_plans import TEST_SIZE, _traj_sql

FLIGHTS_SCHEMA = T.StructType([T.StructField("dest", T.StringType()), T.StructField("origin", T.StringType()),
                               T.StructField("cnt", T.IntegerType())])
POSITION_SCHEMA = T.StructType([T.StructField("mmsi", T.IntegerType()),
                                T.StructField("ts", T.TimestampNTZType()),
                                T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
TRAJ_SCHEMA = T.StructType([T.StructField("mmsi", T.IntegerType()),
                            T.StructField("start_time", T.TimestampNTZType()),
                            T.StructField("end_time", T.TimestampNTZType()),
                            T.StructField("record_count", T.IntegerType())])


@plan("csv_scan", sql=FLIGHTS_SQL)
def csv_scan(spark, sf):
    """Flights written as CSV with a header, read back with an explicit schema."""
    path = files.write_csv(flights(spark, sf), files.scratch_path(spark, "flights"), header=True)
    return files.read_csv(spark, path, FLIGHTS_SCHEMA)


@plan("csv_glob_scan", sql=FLIGHTS_SQL)
def csv_glob_scan(spark, sf):
    """Flights split over two CSV folders, read back as one table by wildcard."""
    fl = flights(spark, sf)
    base = files.scratch_path(spark, "flights-by-year")
    files.write_csv(fl.where(F.col("dest") < F.col("origin")), f"{base}/a", header=True)
    files.write_csv(fl.where(F.col("dest") >= F.col("origin")), f"{base}/b", header=True)
    return files.read_csv(spark, f"{base}/*/*.csv", FLIGHTS_SCHEMA)


@plan("csv_gz_scan", sql=FLIGHTS_SQL)
def csv_gz_scan(spark, sf):
    """Gzip CSV (one task per file) redistributed after the read."""
    path = files.write_csv(flights(spark, sf), files.scratch_path(spark, "flights-gz"), header=True,
                           compression="gzip")
    return files.read_csv(spark, path, FLIGHTS_SCHEMA, rebalance=True)


@plan("range_source", sql="SELECT row_number() OVER () - 1 AS id FROM orders")
def range_source(spark, sf):
    """Generated id column 0..n-1 with n = the number of orders, counted when the query runs."""
    n = read_table(spark, sf, "orders", "o_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return local.ids_up_to(n, "n")


@plan("rdd_bridge", sql="SELECT o_orderkey, upper(o_orderstatus) || '-' || o_orderpriority AS tag, "
                        "o_totalprice * 2 AS doubled FROM orders")
def rdd_bridge(spark, sf):
    """Table -> Arrow record batches (per-partition code) -> table."""
    src = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    import pyarrow.compute as pc

    def per_batch(batches):
        for b in batches:
            tag = pc.binary_join_element_wise(pc.utf8_upper(b.column("o_orderstatus")),
                                              b.column("o_orderpriority"), "-")
            yield pa.RecordBatch.from_arrays(
                [b.column("o_orderkey"), tag, pc.multiply(b.column("o_totalprice"), 2.0)],
                names=["o_orderkey", "tag", "doubled"])

    return src.mapInArrow(per_batch, "o_orderkey long, tag string, doubled double")


@plan("typed_view", sql=f"SELECT mmsi, ts, lat, lon FROM ({POSITIONS_SQL})")
def typed_view(spark, sf):
    """Position records forced to the record schema (mmsi int, ts, lat, lon)."""
    return files.typed_view(positions(spark, sf), POSITION_SCHEMA)


def _position_csv(spark, sf) -> str:
    pos = positions(spark, sf).select(
        "mmsi", F.date_format("ts", files.AIS_TIME_FORMAT).alias("timestamp"),
        F.col("lat").alias("latitude"), F.col("lon").alias("longitude"))
    return files.write_csv(pos, files.scratch_path(spark, "ais"), header=True)


@plan("ais_ingest", sql=f"SELECT mmsi, date_trunc('second', ts) AS ts, lat, lon FROM ({POSITIONS_SQL})")
def ais_ingest(spark, sf):
    """Position CSV (text times dd/MM/yyyy HH:mm:ss) parsed into typed records."""
    raw = files.read_csv(spark, _position_csv(spark, sf), files.AIS_SCHEMA)
    good, _rejects = files.ingest_positions(raw)
    return good


@plan("csv_sink", sql=_traj_sql(TEST_SIZE))
def csv_sink(spark, sf):
    """Trajectories written as headerless CSV in parallel, read back."""
    traj = build_trajectories(positions(spark, sf), size=TEST_SIZE)
    path = files.write_csv(traj, files.scratch_path(spark, "trajectories"), header=False)
    return files.read_csv(spark, path, TRAJ_SCHEMA, header=False)


@plan("temp_view_sql", sql=f"SELECT dest, CAST(sum(cnt) AS BIGINT) AS total FROM ({FLIGHTS_SQL}) GROUP BY dest")
def temp_view_sql(spark, sf):
    """A table queried through SQL text (bound as a parameter, no global name clash)."""
    return spark.sql("SELECT dest, sum(cnt) AS total FROM {flights} GROUP BY dest", flights=flights(spark, sf))


@plan("cache_table", sql=(f"SELECT dest, CAST(sum(cnt) AS BIGINT) AS total, count(*) AS pairs "
                          f"FROM ({FLIGHTS_SQL}) GROUP BY dest"))
def cache_table(spark, sf):
    """A table kept in memory (spilling to disk) and used twice."""
    from pyspark import StorageLevel
    fl = flights(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    totals = fl.groupBy("dest").agg(F.sum("cnt").alias("total"))
    pairs = fl.groupBy("dest").agg(F.count(F.lit(1)).alias("pairs"))
    return totals.join(pairs, "dest")


@plan("checkpoint_table", sql=FLIGHTS_SQL)
def checkpoint_table(spark, sf):
    """Flights materialised to the shared checkpoint folder (lineage cut)."""
    return checkpointed(flights(spark, sf))


@plan("fetch", sql=f"SELECT * FROM ({FLIGHTS_SQL}) ORDER BY cnt DESC, dest, origin LIMIT 5")
def fetch(spark, sf):
    """First five flights under a total order (the rows `take(5)` brings back)."""
    return flights(spark, sf).orderBy(F.desc("cnt"), "dest", "origin").limit(5)


@plan("foreach_partition", sql="SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders")
def foreach_partition(spark, sf):
    """Orders through a writer per partition whose attempts count once, read back by the manifest of its commit."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return sink.read_once(spark, sink.write_once(o, files.scratch_path(spark, "once")), o.schema)
