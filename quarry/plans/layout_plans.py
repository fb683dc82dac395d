"""Partition-control and per-partition plans.

Layout is not visible in SQL, so each plan publishes a checkable property of
the layout (e.g. "every key lies in exactly one partition") next to the rows.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..fixed import PARTITION_TAG_SEPARATOR
from ..operators import partitioning as R
from ..operators import slices as S
from ..sources.fixtures import FLIGHTS_SQL, POSITIONS_SQL, WORDS_SQL, flights, positions, retail, retail_sql, words
from .registry import plan

FL_ = f"({FLIGHTS_SQL})"


def _r(*cols):
    return f"WITH retail AS ({retail_sql(*cols)}) "


@plan("num_partitions", sql="SELECT 5 AS n_partitions")
def num_partitions(spark, sf):
    """Partition count after repartition(5) (layout)."""
    fl = R.repartition_n(flights(spark, sf), 5)
    return fl.select(F.spark_partition_id().alias("pid")).distinct().agg(F.count(F.lit(1)).alias("n_partitions"))


@plan("repartition_n", sql=_r("l_orderkey") + "SELECT f.*, layout.* FROM " + FL_ + " f CROSS JOIN "
      "(SELECT count(*) AS n_rows, 5 AS n_partitions, true AS even FROM retail) layout")
def repartition_n(spark, sf):
    """Round-robin into 5 partitions: all rows of the flights and, beside each, the layout of the far longer lines of sale: all rows, five partitions,
    each within a fifth of its even share."""
    sizes = R.with_partition_id(R.repartition_n(retail(spark, sf, "l_orderkey"), 5)).groupBy("pid").agg(F.count(F.lit(1)).alias("n"))
    share = F.sum("n") / 5
    layout = sizes.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).cast("int").alias("n_partitions"),
                       ((F.min("n") >= 0.8 * share) & (F.max("n") <= 1.2 * share)).alias("even"))
    return R.repartition_n(flights(spark, sf), 5).crossJoin(layout)      # the layout is one row


@plan("repartition_expr", sql=f"SELECT cnt % 10 AS bucket, count(*) AS n_rows, 1 AS n_partitions FROM {FL_} GROUP BY 1")
def repartition_expr(spark, sf):
    """Hash partition by an expression, default partition count: the rows of each value, all in one partition."""
    fl = R.with_partition_id(R.repartition_by(flights(spark, sf), F.col("cnt") % 10))
    return fl.groupBy((F.col("cnt") % 10).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("pid").cast("int").alias("n_partitions"))


@plan("repartition_n_expr", sql=f"SELECT cnt % 10 AS bucket, 1 AS n_partitions FROM {FL_} GROUP BY 1")
def repartition_n_expr(spark, sf):
    """Hash partition by an expression into 10: each bucket value lies in one partition."""
    fl = R.repartition_by(flights(spark, sf), F.col("cnt") % 10, n=10)
    return R.key_partition_spread(fl.withColumn("bucket", F.col("cnt") % 10), "bucket").withColumn(
        "n_partitions", F.col("n_partitions").cast("int"))


@plan("coalesce_n", sql=_r("l_orderkey") + "SELECT f.*, layout.* FROM " + FL_ + " f CROSS JOIN "
      "(SELECT count(*) AS n_rows, 2 AS n_partitions, 0 AS torn FROM retail) layout")
def coalesce_n(spark, sf):
    """Merge 8 partitions into 2 without a full shuffle: all rows of the flights and, beside each, the layout of the far longer lines of sale: all rows,
    two partitions, and none of the eight torn apart."""
    eight = R.with_partition_id(R.repartition_n(retail(spark, sf, "l_orderkey"), 8), "was")
    moved = R.with_partition_id(R.coalesce_n(eight, 2)).groupBy("was").agg(F.count(F.lit(1)).alias("n"), F.collect_set("pid").alias("pids"))
    layout = moved.agg(F.sum("n").alias("n_rows"), F.size(F.array_distinct(F.flatten(F.collect_list("pids")))).alias("n_partitions"),
                       F.count_if(F.size("pids") > 1).cast("int").alias("torn"))
    return R.coalesce_n(R.repartition_n(flights(spark, sf), 8), 2).crossJoin(layout)      # the layout is one row


@plan("nonempty_partitions", sql=f"SELECT count(DISTINCT cnt % 10) AS n_values, true AS at_most_a_partition_each FROM {FL_}")
def nonempty_partitions(spark, sf):
    """Partitions holding rows after hash partitioning by an expression into 200: at least one, at most one for each value."""
    fl = R.repartition_by(flights(spark, sf), F.col("cnt") % 10, n=200)
    counts = R.with_partition_id(fl).agg(F.count_distinct(F.col("cnt") % 10).alias("n_values"), F.count_distinct("pid").alias("nonempty"))
    return counts.select("n_values", F.col("nonempty").between(F.lit(1), F.col("n_values")).alias("at_most_a_partition_each"))


@plan("partition_hash", sql=_r("o_custkey") +
      "SELECT o_custkey, 1 AS n_partitions FROM retail GROUP BY o_custkey")
def partition_hash(spark, sf):
    """Hash partitioning by customer into 10: every customer in exactly one partition."""
    r = R.repartition_by(retail(spark, sf, "o_custkey"), "o_custkey", n=10)
    return R.key_partition_spread(r, "o_custkey").withColumn("n_partitions", F.col("n_partitions").cast("int"))


@plan("partition_range", sql=_r("o_custkey") +
      "SELECT o_custkey, 1 AS n_partitions FROM retail GROUP BY o_custkey")
def partition_range(spark, sf):
    """Range partitioning by customer into 10 (sampled bounds): one partition per customer."""
    r = R.repartition_by_range(retail(spark, sf, "o_custkey"), 10, F.asc("o_custkey"))
    return R.key_partition_spread(r, "o_custkey").withColumn("n_partitions", F.col("n_partitions").cast("int"))


@plan("partition_range_balanced", sql=_r("o_custkey") + "SELECT count(*) AS n_rows, true AS in_order, true AS balanced FROM retail")
def partition_range_balanced(spark, sf):
    """Range partitioning by (customer, order, part) into 10, the sampled bounds cutting through the hot customer: every partition's
    last customer is at or before the next one's first, and none holds more than twice its even share."""
    cut = S.ordered_slices(retail(spark, sf, "o_custkey", "l_orderkey", "l_partkey"), ["o_custkey"], ["l_orderkey", "l_partkey"], 10)
    first, last = F.struct(F.coalesce("o_custkey", F.lit(-1.0)).alias("k")), F.struct(F.coalesce("o_custkey", F.lit(-1.0)).alias("k"))
    parts = cut.groupBy("_r_slice").agg(F.min(first).alias("lo"), F.max(last).alias("hi"), F.count(F.lit(1)).alias("n"))
    after = F.lead("lo").over(Window.orderBy("_r_slice"))          # a row a partition
    return parts.withColumn("fits", F.coalesce(F.col("hi") <= after, F.lit(True))).agg(
        F.sum("n").alias("n_rows"), F.bool_and("fits").alias("in_order"), (F.max("n") <= 2 * F.sum("n") / 10).alias("balanced"))


@plan("partition_custom", sql=_r("l_orderkey", "l_partkey", "o_custkey") +
      "SELECT o_custkey IS NULL AS is_hot, CASE WHEN o_custkey IS NULL THEN 0 ELSE 3 END AS min_pid, "
      "CASE WHEN o_custkey IS NULL THEN 2 ELSE 4 END AS max_pid, count(*) AS n FROM retail GROUP BY 1")
def partition_custom(spark, sf):
    """The hot key (the missing customer, a tenth of all rows) alone in partitions 0-2,
    the rest in partitions 3-4, both spread by a hash."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "o_custkey")
    p = R.isolate_hot_key(r, "o_custkey", None, 2, ["l_orderkey", "l_partkey"], n_hot=3)
    p = p.withColumn("pid", F.spark_partition_id())
    return p.groupBy(F.col("o_custkey").isNull().alias("is_hot")).agg(
        F.min("pid").alias("min_pid"), F.max("pid").alias("max_pid"), F.count(F.lit(1)).alias("n"))


@plan("partition_subkey", sql=f"SELECT mmsi, 1 AS n_partitions FROM ({POSITIONS_SQL}) GROUP BY mmsi")
def partition_subkey(spark, sf):
    """Partitioning by the first part (vessel) of the composite (vessel, time) key."""
    p = R.repartition_by(positions(spark, sf).select("mmsi", "ts"), "mmsi")
    return R.key_partition_spread(p, "mmsi").withColumn("n_partitions", F.col("n_partitions").cast("int"))


@plan("map_partitions", sql=f"SELECT count(*) AS n FROM ({WORDS_SQL})")
def map_partitions(spark, sf):
    """A function over each partition's iterator of records, here one that counts them; its results summed."""
    def count(batches):
        yield (sum(b.num_rows for b in batches),)
    return R.map_partitions(words(spark, sf), count, "n long").agg(F.sum("n").alias("n"))


@plan("map_partitions_index", sql=f"SELECT word, true AS numbered FROM ({WORDS_SQL})")
def map_partitions_index(spark, sf):
    """Each word prefixed with its partition number; the number varies with the layout, the rest is the word."""
    tagged = words(spark, sf).select(R.tag_with_partition("word").alias("tagged"))
    sep = PARTITION_TAG_SEPARATOR
    at = F.instr("tagged", sep)
    return tagged.select(F.substr("tagged", at + len(sep)).alias("word"),
                         F.substr("tagged", F.lit(1), at - 1).rlike("^[0-9]+$").alias("numbered"))


@plan("glom", sql=f"SELECT origin, dest, cnt, true AS in_one_of_four FROM {FL_}")
def glom(spark, sf):
    """Each partition of the flights as one array, taken apart again."""
    arrays = R.glom(R.repartition_n(flights(spark, sf), 4))
    return arrays.select("pid", F.explode("rows").alias("r")).select(
        "r.origin", "r.dest", "r.cnt", F.col("pid").between(0, 3).alias("in_one_of_four"))


@plan("pipe_partitions", sql=f"SELECT count(*) AS n FROM ({WORDS_SQL})")
def pipe_partitions(spark, sf):
    """Each partition's words piped through `wc -l`; the per-partition line counts summed."""
    out = R.pipe_partitions(words(spark, sf), "word", ["wc", "-l"])
    return out.agg(F.sum(F.trim("line").cast("long")).alias("n"))
