"""Join, co-group, zip and per-key aggregation plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import heavy as H
from ..operators import joins as J
from ..operators import keyvalue as KV
from ..sources.fixtures import LETTERS_SQL, WORDS_SQL, WS, letters, words
from ..sources.tables import read_table
from ..streaming.cogroup import cogroup_streams as streams
from .registry import plan

WD_ = f"({WORDS_SQL})"
LT_ = f"({LETTERS_SQL})"


@plan("join_inner", sql="SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem "
                        "JOIN orders ON o_orderkey = l_orderkey")
def join_inner(spark, sf):
    """Inner equi join by key; Spark places the shuffle, if it needs one."""
    li = read_table(spark, sf, "lineitem", "l_orderkey", "l_linenumber")
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderstatus").withColumnRenamed("o_orderkey", "l_orderkey")
    return J.join(li, o, "l_orderkey", "inner")


@plan("join_heavy_keys", sql="SELECT c_nationkey AS nationkey, c_mktsegment, count(*) AS pairs, count(*) FILTER (s_acctbal > c_acctbal) AS richer, "
                             "min(s_suppkey) AS first_supplier FROM customer JOIN supplier ON s_nationkey = c_nationkey GROUP BY ALL")
def join_heavy_keys(spark, sf):
    """Customers and suppliers of one nation (few keys, each heavy on both sides), joined on grids: per nation and segment the pairs, and those
    in which the supplier's balance is the larger one."""
    c = read_table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal").withColumnRenamed("c_nationkey", "nationkey")
    s = read_table(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal").withColumnRenamed("s_nationkey", "nationkey")
    return H.grid_join(c, s, "nationkey").groupBy("nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("s_acctbal") > F.col("c_acctbal")).alias("richer"), F.min("s_suppkey").alias("first_supplier"))


FINISHED = "(SELECT o_custkey, count(*) AS n_finished FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)"
OPEN = "(SELECT o_custkey, count(*) AS n_open FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey)"


def _per_customer(spark, sf, status, name):
    o = read_table(spark, sf, "orders", "o_custkey", "o_orderstatus")
    return o.where(F.col("o_orderstatus") == status).groupBy("o_custkey").agg(F.count(F.lit(1)).alias(name))


@plan("join_left", sql=f"SELECT c_custkey, n_finished FROM customer LEFT JOIN {FINISHED} f ON f.o_custkey = c_custkey")
def join_left(spark, sf):
    """Left outer: every customer, null where it has no finished order."""
    c = read_table(spark, sf, "customer", "c_custkey")
    f = _per_customer(spark, sf, "F", "n_finished")
    return c.join(f, c.c_custkey == f.o_custkey, "left").select("c_custkey", "n_finished")


@plan("join_right", sql=f"SELECT c_custkey, n_finished FROM {FINISHED} f RIGHT JOIN customer ON f.o_custkey = c_custkey")
def join_right(spark, sf):
    """Right outer."""
    c = read_table(spark, sf, "customer", "c_custkey")
    f = _per_customer(spark, sf, "F", "n_finished")
    return f.join(c, c.c_custkey == f.o_custkey, "right").select("c_custkey", "n_finished")


@plan("join_full", sql=f"SELECT coalesce(f.o_custkey, o.o_custkey) AS custkey, n_finished, n_open "
                       f"FROM {FINISHED} f FULL JOIN {OPEN} o ON f.o_custkey = o.o_custkey")
def join_full(spark, sf):
    """Full outer."""
    f = _per_customer(spark, sf, "F", "n_finished")
    o = _per_customer(spark, sf, "O", "n_open")
    return f.join(o, "o_custkey", "full").select(F.col("o_custkey").alias("custkey"), "n_finished", "n_open")


def _conv_letters(spark, sf):
    conv = read_table(spark, sf, "conversations", "text")
    chars = F.split(F.regexp_replace(F.lower("text"), WS, ""), "")
    return conv.select(F.explode(chars).alias("key")).where(F.length("key") > 0)


CONV_LETTERS_SQL = ("(SELECT unnest(string_split(lower(word), '')) AS key FROM (SELECT unnest("
                    f"regexp_split_to_array(text, '{WS}')) AS word FROM conversations) WHERE length(word) > 0)")


@plan("cogroup", sql=f"SELECT coalesce(a.key, b.key) AS key, CASE WHEN a.n IS NULL THEN [] ELSE [a.n] END AS left_values, "
                     f"CASE WHEN b.n IS NULL THEN [] ELSE [b.n] END AS right_values FROM "
                     f"(SELECT key, count(*) AS n FROM {LT_} GROUP BY key) a FULL JOIN "
                     f"(SELECT key, count(*) AS n FROM {CONV_LETTERS_SQL} GROUP BY key) b ON a.key = b.key")
def cogroup(spark, sf):
    """Per letter, the values of both sides (letter counts in documents and in conversations)."""
    a = letters(spark, sf).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    b = _conv_letters(spark, sf).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return J.cogroup_lists(a, b, "key", "n", "n")


@plan("cogroup_streams", sql=(
    "WITH f AS (SELECT o_custkey, count(*) AS n_finished, max(o_totalprice) AS largest FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) "
    "SELECT o.o_custkey, o_orderkey, CAST(row_number() OVER (PARTITION BY o.o_custkey ORDER BY o_orderkey) AS BIGINT) AS place, "
    "coalesce(n_finished, 0) AS n_finished, o_totalprice > largest AS above_finished "
    "FROM orders o LEFT JOIN f ON f.o_custkey = o.o_custkey WHERE o_orderstatus = 'O'"))
def cogroup_streams(spark, sf):
    """Per customer, the stream of finished orders and that of open ones, handed to user code: every open order beside what the finished ones showed."""
    def beside(key, finished, open_orders):
        n, largest = 0, None
        for row in finished:
            n, largest = n + 1, row["o_totalprice"] if largest is None else max(largest, row["o_totalprice"])
        for place, row in enumerate(open_orders, 1):
            yield (*key, row["o_orderkey"], place, n, None if largest is None else row["o_totalprice"] > largest)

    orders = read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    finished, open_orders = (orders.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "FO")
    return streams(finished, open_orders, ["o_custkey"], beside, "o_custkey long, o_orderkey long, place long, n_finished long, above_finished boolean",
                   ["o_orderkey"], ["o_orderkey"])


BENCH_WORDS = (f"(SELECT word, count(*) AS freq FROM (SELECT unnest(regexp_split_to_array(text, '{WS}')) AS word "
               "FROM benchmark) WHERE length(word) > 0 GROUP BY word)")


@plan("broadcast_lookup", sql=f"SELECT w.word, coalesce(b.freq, 0) AS freq FROM (SELECT DISTINCT word FROM {WD_}) w "
                              f"LEFT JOIN {BENCH_WORDS} b ON b.word = w.word ORDER BY freq")
def broadcast_lookup(spark, sf):
    """Distinct document words enriched from a lookup (word frequency in the
    benchmark texts), default 0, sorted by the value."""
    bench = read_table(spark, sf, "benchmark", "text")
    lookup = (bench.select(F.explode(F.split("text", WS)).alias("word")).where(F.length("word") > 0)
              .groupBy("word").agg(F.count(F.lit(1)).alias("freq")))
    w = words(spark, sf).select("word").distinct()
    return J.broadcast_lookup(w, lookup, "word", "freq", default=0).orderBy("freq")


@plan("zip_positional", sql="SELECT a.o_orderkey, b.o_totalprice FROM "
                            "(SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) a JOIN "
                            "(SELECT o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS i "
                            "FROM orders) b ON a.i = b.i")
def zip_positional(spark, sf):
    """Row i of orders by key paired with row i of orders by price descending."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    by_key = o.select("o_orderkey")
    # descending price (ties by key) as an ascending order on the negated price
    by_price = o.select((-F.col("o_totalprice")).alias("_neg"), "o_totalprice", F.col("o_orderkey").alias("_k"))
    out = J.zip_positional(by_key, by_price, ["o_orderkey"], ["_neg", "_k"],
                          int(spark.conf.get("spark.sql.shuffle.partitions")))
    return out.select("o_orderkey", "o_totalprice")


# --- per-key aggregation on (letter, 1) ------------------------------------------------

@plan("count_by_key", sql=f"SELECT key, count(*) AS count FROM {LT_} GROUP BY key")
def count_by_key(spark, sf):
    """Count per key."""
    return KV.count_by_key(letters(spark, sf))


@plan("reduce_by_key", sql=f"SELECT key, CAST(sum(value) AS BIGINT) AS value FROM {LT_} GROUP BY key")
def reduce_by_key(spark, sf):
    """Per-key sum with map-side combine."""
    return KV.reduce_by_key(letters(spark, sf))


@plan("group_by_key", sql=f"SELECT key, CAST(sum(value) AS BIGINT) AS value FROM {LT_} GROUP BY key")
def group_by_key(spark, sf):
    """Group by key, then reduce each key's values (no value list is built)."""
    return KV.group_by_key_reduce(letters(spark, sf))


@plan("aggregate_by_key", sql=f"SELECT key, CAST(sum(value) AS BIGINT) AS value FROM {LT_} GROUP BY key")
def aggregate_by_key(spark, sf):
    """Zero, within-partition fold and merge per key (user aggregate path)."""
    return KV.aggregate_by_key(letters(spark, sf), "sum", 0)


@plan("fold_by_key", sql=f"SELECT key, max(value) AS value FROM {LT_} GROUP BY key")
def fold_by_key(spark, sf):
    """One function for fold and merge (here: max, zero 0)."""
    return KV.fold_by_key(letters(spark, sf), "max", 0)


@plan("combine_by_key", sql=f"SELECT key, [1] AS \"values\", [count(*)] AS counts FROM {LT_} GROUP BY key")
def combine_by_key(spark, sf):
    """Per-key value lists (run-length encoded) in 10 partitions."""
    return KV.combine_by_key_lists(letters(spark, sf), 10)
