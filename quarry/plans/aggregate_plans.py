"""Aggregation plans over the retail, flights, orders and words fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import metrics as MR
from ..operators import sketches as Q
from ..sources.fixtures import FLIGHTS_SQL, WORDS_SQL, flights, retail, retail_sql, words
from ..sources.materialize import checkpointed
from ..sources.tables import read_table
from .registry import plan

FL_ = f"({FLIGHTS_SQL})"
WD_ = f"({WORDS_SQL})"


def _r(*cols: str) -> str:
    return f"WITH retail AS ({retail_sql(*cols)}) "


def _month(c: str = "l_shipdate"):
    return F.trunc(F.to_date(c), "month").alias("month")


NATIONS = [f"NATION_{i}" for i in range(25)]
MONTH_SQL = "CAST(date_trunc('month', l_shipdate) AS DATE)"


@plan("count_rows", sql="SELECT count(*) AS n FROM lineitem")
def count_rows(spark, sf):
    """Row count."""
    return retail(spark, sf, "l_quantity").agg(F.count(F.lit(1)).alias("n"))


@plan("count_column", sql=_r("o_custkey") + "SELECT count(o_custkey) AS n FROM retail")
def count_column(spark, sf):
    """Non-null count."""
    return retail(spark, sf, "o_custkey").agg(F.count("o_custkey").alias("n"))


@plan("count_distinct", sql=_r("l_partkey") + "SELECT count(DISTINCT l_partkey) AS n FROM retail")
def count_distinct(spark, sf):
    """Exact distinct count."""
    return retail(spark, sf, "l_partkey").agg(F.count_distinct("l_partkey").alias("n"))


@plan("approx_distinct", sql=_r("l_partkey") + "SELECT count(DISTINCT l_partkey) AS n, true AS approx_within FROM retail")
def approx_distinct(spark, sf):
    """HyperLogLog distinct count with relative standard deviation 0.1, held against the exact count:
    within three deviations."""
    both = retail(spark, sf, "l_partkey").agg(F.count_distinct("l_partkey").alias("n"),
                                              F.approx_count_distinct("l_partkey", 0.1).alias("approx"))
    return both.select("n", (F.abs(F.col("approx") - F.col("n")) <= 0.3 * F.col("n")).alias("approx_within"))


@plan("first_last", sql=_r("l_partkey", "l_shipdate", "n_name") +
      "SELECT n_name, first(l_partkey ORDER BY l_shipdate, l_partkey) AS first_code, "
      "last(l_partkey ORDER BY l_shipdate, l_partkey) AS last_code FROM retail GROUP BY n_name")
def first_last(spark, sf):
    """First and last value per group under an explicit order."""
    r = retail(spark, sf, "l_partkey", "l_shipdate", "n_name")
    return r.groupBy("n_name").agg(A.ordered_first("l_partkey", "l_shipdate").alias("first_code"),
                                    A.ordered_last("l_partkey", "l_shipdate").alias("last_code"))


@plan("min_max", sql=_r("l_quantity", "p_retailprice") +
      "SELECT min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, min(p_retailprice) AS min_price, "
      "max(p_retailprice) AS max_price FROM retail")
def min_max(spark, sf):
    """Minimum and maximum."""
    r = retail(spark, sf, "l_quantity", "p_retailprice")
    return r.agg(F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
                 F.min("p_retailprice").alias("min_price"), F.max("p_retailprice").alias("max_price"))


@plan("sum_column", sql=_r("l_quantity") + "SELECT CAST(sum(l_quantity) AS BIGINT) AS total FROM retail")
def sum_column(spark, sf):
    """Sum."""
    return retail(spark, sf, "l_quantity").agg(F.sum("l_quantity").alias("total"))


@plan("sum_distinct", sql=_r("l_quantity") + "SELECT CAST(sum(DISTINCT l_quantity) AS BIGINT) AS total FROM retail")
def sum_distinct(spark, sf):
    """Sum of distinct values."""
    return retail(spark, sf, "l_quantity").agg(F.sum_distinct("l_quantity").alias("total"))


@plan("avg_column", sql=_r("l_quantity") +
      "SELECT avg(l_quantity) AS avg1, avg(l_quantity) AS avg2, avg(l_quantity) AS avg3 FROM retail")
def avg_column(spark, sf):
    """Mean, three spellings (Column, name, SQL text)."""
    r = retail(spark, sf, "l_quantity")
    return r.agg(F.avg(F.col("l_quantity")).alias("avg1"), F.avg("l_quantity").alias("avg2"),
                 F.expr("avg(l_quantity)").alias("avg3"))


@plan("var_samp", sql=_r("l_quantity") + "SELECT round(var_samp(l_quantity), 6) AS v FROM retail")
def var_samp(spark, sf):
    """Sample variance."""
    return retail(spark, sf, "l_quantity").agg(F.round(F.var_samp("l_quantity"), 6).alias("v"))


@plan("var_pop", sql=_r("l_quantity") + "SELECT round(var_pop(l_quantity), 6) AS v FROM retail")
def var_pop(spark, sf):
    """Population variance."""
    return retail(spark, sf, "l_quantity").agg(F.round(F.var_pop("l_quantity"), 6).alias("v"))


@plan("skewness", sql=_r("l_quantity") +
      "SELECT round((avg(power(l_quantity, 3)) - 3 * avg(l_quantity) * avg(power(l_quantity, 2)) "
      "+ 2 * power(avg(l_quantity), 3)) / power(var_pop(l_quantity), 1.5), 6) AS skew FROM retail")
def skewness(spark, sf):
    """Population skewness."""
    return retail(spark, sf, "l_quantity").agg(F.round(F.skewness("l_quantity"), 6).alias("skew"))


@plan("kurtosis", sql=_r("l_quantity") + "SELECT round(kurtosis_pop(l_quantity), 6) AS kurt FROM retail")
def kurtosis(spark, sf):
    """Population excess kurtosis."""
    return retail(spark, sf, "l_quantity").agg(F.round(F.kurtosis("l_quantity"), 6).alias("kurt"))


@plan("corr", sql=_r("l_quantity", "p_retailprice") +
      "SELECT round(corr(l_quantity, p_retailprice), 6) AS c1, round(corr(l_quantity, p_retailprice), 6) AS c2 FROM retail")
def corr(spark, sf):
    """Pearson correlation, two spellings (function and stat accessor form)."""
    r = retail(spark, sf, "l_quantity", "p_retailprice")
    return r.agg(F.round(F.corr("l_quantity", "p_retailprice"), 6).alias("c1"),
                 F.round(F.expr("corr(l_quantity, p_retailprice)"), 6).alias("c2"))


@plan("covariance", sql=_r("l_quantity", "p_retailprice") +
      "SELECT round(covar_samp(l_quantity, p_retailprice), 4) AS cov_samp, "
      "round(covar_pop(l_quantity, p_retailprice), 4) AS cov_pop FROM retail")
def covariance(spark, sf):
    """Sample and population covariance."""
    r = retail(spark, sf, "l_quantity", "p_retailprice")
    return r.agg(F.round(F.covar_samp("l_quantity", "p_retailprice"), 4).alias("cov_samp"),
                 F.round(F.covar_pop("l_quantity", "p_retailprice"), 4).alias("cov_pop"))


@plan("collect_list", sql=_r("l_orderkey", "l_quantity") +
      "SELECT l_orderkey, list_sort(list(l_quantity)) AS quantities FROM retail GROUP BY l_orderkey")
def collect_list(spark, sf):
    """All values per invoice as a sorted list (an invoice's lines are bounded)."""
    r = retail(spark, sf, "l_orderkey", "l_quantity")
    return r.groupBy("l_orderkey").agg(A.sorted_list("l_quantity").alias("quantities"))


@plan("collect_set", sql=_r("l_quantity", "n_name") +
      "SELECT n_name, list_sort(list(DISTINCT l_quantity)) AS quantities FROM retail GROUP BY n_name")
def collect_set(spark, sf):
    """Distinct values per country as a sorted set (bounded by the value domain)."""
    r = retail(spark, sf, "l_quantity", "n_name")
    return r.groupBy("n_name").agg(A.sorted_set("l_quantity").alias("quantities"))


@plan("value_counts", sql=_r("l_quantity", "n_name") +
      "SELECT n_name, list(l_quantity ORDER BY l_quantity) AS \"values\", list(n ORDER BY l_quantity) AS counts "
      "FROM (SELECT n_name, l_quantity, count(*) AS n FROM retail WHERE l_quantity IS NOT NULL GROUP BY 1, 2) "
      "GROUP BY n_name")
def value_counts(spark, sf):
    """Run-length form of a per-group value list (bounded by distinct values)."""
    return A.value_counts(retail(spark, sf, "l_quantity", "n_name"), ["n_name"], "l_quantity")


@plan("group_count", sql=_r("l_orderkey") + "SELECT l_orderkey, count(*) AS count FROM retail GROUP BY l_orderkey")
def group_count(spark, sf):
    """Rows per group."""
    return retail(spark, sf, "l_orderkey").groupBy("l_orderkey").count()


@plan("group_min_max_mean", sql=_r("l_quantity", "p_retailprice", "n_name") +
      "SELECT n_name, min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity, "
      "round(avg(l_quantity), 6) AS avg_l_quantity, min(p_retailprice) AS min_p_retailprice, max(p_retailprice) AS max_p_retailprice, "
      "round(avg(p_retailprice), 6) AS avg_p_retailprice FROM retail GROUP BY n_name")
def group_min_max_mean(spark, sf):
    """Short-hand min/max/mean over every numeric column per group."""
    s = A.numeric_summary(retail(spark, sf, "l_quantity", "p_retailprice", "n_name"), ["n_name"])
    return s.select("n_name", *[F.round(c, 6).alias(c) if c.startswith("avg_") else F.col(c)
                                 for c in s.columns if c != "n_name"])


@plan("group_multi_agg", sql=_r("l_partkey", "l_quantity", "n_name") +
      "SELECT n_name, count(DISTINCT l_partkey) AS n_codes, min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, "
      "list_sort(list(DISTINCT l_quantity)) AS quantities FROM retail GROUP BY n_name")
def group_multi_agg(spark, sf):
    """Several aggregates per group, including a distinct count and a set."""
    r = retail(spark, sf, "l_partkey", "l_quantity", "n_name")
    return r.groupBy("n_name").agg(F.count_distinct("l_partkey").alias("n_codes"),
                                    F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
                                    A.sorted_set("l_quantity").alias("quantities"))


@plan("group_pair_agg", sql=_r("l_orderkey", "l_partkey", "l_quantity") +
      "SELECT l_orderkey, count(l_quantity) AS count_l_quantity, min(l_quantity) AS min_l_quantity, "
      "list_sort(list(DISTINCT l_partkey)) AS collect_set_l_partkey FROM retail GROUP BY l_orderkey")
def group_pair_agg(spark, sf):
    """Aggregates given as (column, function) pairs with a repeated column."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity")
    return A.pair_aggregates(r, ["l_orderkey"], [("l_quantity", "count"), ("l_quantity", "min"),
                                                ("l_partkey", "collect_set")])


@plan("grouping_sets", sql=_r("l_partkey", "l_quantity", "o_custkey") +
      "SELECT o_custkey, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS total_qty FROM retail "
      "WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL "
      "GROUP BY GROUPING SETS ((o_custkey, l_partkey), (l_partkey)) ORDER BY o_custkey DESC, l_partkey DESC")
def grouping_sets(spark, sf):
    """Sums for (customer, stock) and (stock) in one pass, nulls removed first, SQL text."""
    r = retail(spark, sf, "l_partkey", "l_quantity", "o_custkey").dropna(subset=["o_custkey", "l_partkey"])
    return spark.sql(
        "SELECT o_custkey, l_partkey, sum(l_quantity) AS total_qty FROM {r} "
        "GROUP BY o_custkey, l_partkey GROUPING SETS ((o_custkey, l_partkey), (l_partkey)) "
        "ORDER BY o_custkey DESC, l_partkey DESC", r=r)


@plan("rollup", sql=_r("l_shipdate", "l_quantity", "n_name") +
      f"SELECT {MONTH_SQL} AS month, n_name, CAST(sum(l_quantity) AS BIGINT) AS total_qty, "
      f"CAST(grouping({MONTH_SQL}, n_name) AS INTEGER) AS gid FROM retail GROUP BY ROLLUP ({MONTH_SQL}, n_name)")
def rollup(spark, sf):
    """Hierarchical subtotals month > country with the level id."""
    r = retail(spark, sf, "l_shipdate", "l_quantity", "n_name").select(_month(), "n_name", "l_quantity")
    out = A.rollup(r, ["month", "n_name"], F.sum("l_quantity").alias("total_qty"))
    return out.withColumn("gid", F.col("gid").cast("int"))


@plan("cube", sql=_r("l_shipdate", "l_quantity", "n_name") +
      f"SELECT {MONTH_SQL} AS month, n_name, CAST(sum(l_quantity) AS BIGINT) AS total_qty, "
      f"CAST(grouping({MONTH_SQL}, n_name) AS INTEGER) AS gid FROM retail GROUP BY CUBE ({MONTH_SQL}, n_name)")
def cube(spark, sf):
    """Subtotals for all subsets of (month, country)."""
    r = retail(spark, sf, "l_shipdate", "l_quantity", "n_name").select(_month(), "n_name", "l_quantity")
    out = A.cube(r, ["month", "n_name"], F.sum("l_quantity").alias("total_qty"))
    return out.withColumn("gid", F.col("gid").cast("int"))


@plan("grouping_id", sql=_r("l_shipdate", "n_name") +
      "SELECT CAST(year(l_shipdate) AS INTEGER) AS yr, n_name, "
      "CAST(grouping(year(l_shipdate), n_name) AS INTEGER) AS level, count(*) AS n "
      "FROM retail GROUP BY CUBE (year(l_shipdate), n_name)")
def grouping_id(spark, sf):
    """Level number of each cube row: 0 detail, 1 year total, 2 country total, 3 grand total."""
    r = retail(spark, sf, "l_shipdate", "n_name").select(F.year("l_shipdate").alias("yr"), "n_name")
    return r.cube("yr", "n_name").agg(F.grouping_id().cast("int").alias("level"),
                                       F.count(F.lit(1)).alias("n"))


@plan("pivot", sql=_r("l_shipdate", "l_quantity", "n_name") +
      f"SELECT {MONTH_SQL} AS month, " + ", ".join(
          f"CAST(sum(l_quantity) FILTER (n_name = '{n}') AS BIGINT) AS {n}_total_qty, "
          f"avg(l_quantity) FILTER (n_name = '{n}') AS {n}_avg_qty" for n in NATIONS) + " FROM retail GROUP BY 1")
def pivot(spark, sf):
    """One row per month, columns <n_name>_total_qty and <n_name>_avg_qty.

    The pivot values are the nation dimension's names, so no pass over the fact
    rows is needed and the column set is fixed."""
    r = retail(spark, sf, "l_shipdate", "l_quantity", "n_name").select(_month(), "n_name", "l_quantity")
    return A.pivot(r, ["month"], "n_name", F.sum("l_quantity").alias("total_qty"),
                   F.avg("l_quantity").alias("avg_qty"), values=NATIONS)


def _describe_sql(cols):
    parts = [f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
             f"round(stddev_samp({c}), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
             f"CAST(max({c}) AS DOUBLE) AS max FROM retail" for c in cols]
    return " UNION ALL ".join(parts)


@plan("describe", sql=_r("l_quantity", "p_retailprice") + _describe_sql(["l_quantity", "p_retailprice"]))
def describe(spark, sf):
    """count, mean, stddev, min, max per numeric column (typed long form)."""
    d = A.describe_long(retail(spark, sf, "l_quantity", "p_retailprice"))
    return d.select("column", "count", F.round("mean", 6).alias("mean"), F.round("stddev", 6).alias("stddev"),
                    "min", "max")


@plan("approx_quantile", sql=_r("l_quantity", "n_name") +
      "SELECT n_name, unnest([0.25, 0.5, 0.75]) AS p, true AS rank_within FROM retail GROUP BY n_name")
def approx_quantile(spark, sf):
    """Quartiles with relative rank error 0.05, each held against the ranks that its value really has."""
    r, probs = retail(spark, sf, "l_quantity", "n_name"), [0.25, 0.5, 0.75]
    approx = r.groupBy("n_name").agg(F.percentile_approx("l_quantity", probs, 20).alias("q")).select(
        "n_name", F.explode(F.arrays_zip(F.array(*map(F.lit, probs)).alias("p"), F.col("q").alias("q"))).alias("x"))
    ranks = approx.select("n_name", "x.p", "x.q").join(r, "n_name").groupBy("n_name", "p").agg(
        (F.count_if(F.col("l_quantity") < F.col("q")) / F.count("l_quantity")).alias("below"),
        (F.count_if(F.col("l_quantity") <= F.col("q")) / F.count("l_quantity")).alias("upto"))
    return ranks.select("n_name", "p", ((F.col("below") <= F.col("p") + 0.05) & (F.col("upto") >= F.col("p") - 0.05)).alias("rank_within"))


@plan("exact_quantile", sql=_r("l_quantity", "n_name") +
      "SELECT n_name, quantile_cont(l_quantity, [0.25, 0.5, 0.75]) AS quartiles FROM retail GROUP BY n_name")
def exact_quantile(spark, sf):
    """Exact quartiles (linear interpolation)."""
    r = retail(spark, sf, "l_quantity", "n_name")
    return r.groupBy("n_name").agg(F.percentile("l_quantity", [0.25, 0.5, 0.75]).alias("quartiles"))


@plan("exact_quantile_spread", sql="SELECT o_orderstatus, list_transform(quantile_cont(o_totalprice, [0.01, 0.25, 0.5, 0.75, 0.99]), lambda q: round(q, 4)) AS quantiles "
                                  "FROM orders GROUP BY o_orderstatus")
def exact_quantile_spread(spark, sf):
    """Exact quantiles per group of a nearly all-distinct column, by distributed selection: no group's values stand in one buffer."""
    o = read_table(spark, sf, "orders", "o_orderstatus", "o_totalprice")
    out = Q.exact_quantiles(o, ["o_orderstatus"], "o_totalprice", [0.01, 0.25, 0.5, 0.75, 0.99])
    return out.select("o_orderstatus", F.transform("quantiles", lambda q: F.round(q, 4)).alias("quantiles"))


@plan("quantile_sketch_merged", sql="SELECT 'priority' AS level, o_orderpriority, p, true AS rank_within FROM orders, (SELECT unnest([0.25, 0.5, 0.75]) AS p) GROUP BY ALL "
                                   "UNION ALL SELECT 'total', NULL, unnest([0.25, 0.5, 0.75]), true")
def quantile_sketch_merged(spark, sf):
    """Quantile sketches per (priority, status), stored, then merged to each priority and to the total without the rows; every quartile
    is held against the ranks that it really has in the table (within 0.02)."""
    o = read_table(spark, sf, "orders", "o_orderpriority", "o_orderstatus", "o_totalprice")
    fine = checkpointed(Q.quantile_sketches(o, ["o_orderpriority", "o_orderstatus"], "o_totalprice"))
    both = (Q.merge_sketches(fine, ["o_orderpriority"], "double").select(F.lit("priority").alias("level"), "o_orderpriority", "sketch")
            .union(Q.merge_sketches(fine, [], "double").select(F.lit("total"), F.lit(None).cast("string"), "sketch")))
    asked = checkpointed(both.select("level", "o_orderpriority", F.explode(F.array(*[
        F.struct(F.lit(p).alias("p"), Q.sketch_quantile("sketch", "double", p).alias("q")) for p in (0.25, 0.5, 0.75)])).alias("x")))
    rows = o.select(F.explode(F.array(F.struct(F.lit("priority").alias("level"), F.col("o_orderpriority")),
                                      F.struct(F.lit("total").alias("level"), F.lit(None).cast("string").alias("o_orderpriority")))).alias("at"), "o_totalprice")
    held = rows.join(asked.select(F.struct("level", "o_orderpriority").alias("at"), "x"), "at").groupBy("at", "x.p").agg(
        (F.count_if(F.col("o_totalprice") < F.col("x.q")) / F.count(F.lit(1))).alias("below"),
        (F.count_if(F.col("o_totalprice") <= F.col("x.q")) / F.count(F.lit(1))).alias("upto"))
    return held.select("at.level", "at.o_orderpriority", "p", ((F.col("below") <= F.col("p") + 0.02) & (F.col("upto") >= F.col("p") - 0.02)).alias("rank_within"))


@plan("crosstab", sql=_r("l_partkey", "p_retailprice") +
      "SELECT l_partkey, p_retailprice, count(*) AS count FROM retail GROUP BY l_partkey, p_retailprice")
def crosstab(spark, sf):
    """Contingency table of two columns (long form)."""
    return A.crosstab_long(retail(spark, sf, "l_partkey", "p_retailprice"), "l_partkey", "p_retailprice")


UNITS = [str(i) for i in range(1, 51)]      # the quantities that a line can have


@plan("crosstab_wide", sql=_r("l_quantity", "n_name") + "SELECT n_name AS \"n_name_l_quantity\", " + ", ".join(
      f"count(*) FILTER (l_quantity = {u}) AS \"{u}\"" for u in UNITS) + " FROM retail GROUP BY n_name")
def crosstab_wide(spark, sf):
    """Contingency table in the wide layout: first column ``n_name_l_quantity``."""
    return A.crosstab_wide(retail(spark, sf, "l_quantity", "n_name"), "n_name", "l_quantity", UNITS)


@plan("partition_max_sum", sql="SELECT round(sum(m), 2) AS result FROM "
                               "(SELECT max(o_totalprice) AS m FROM orders GROUP BY o_orderpriority)")
def partition_max_sum(spark, sf):
    """Sum over slices (order priorities) of the slice maximum."""
    o = read_table(spark, sf, "orders", "o_orderpriority", "o_totalprice")
    out = A.per_partition_then_total(o, "o_orderpriority", "o_totalprice")
    return out.select(F.round("result", 2).alias("result"))


@plan("tree_aggregate", sql="SELECT round(sum(m), 2) AS result FROM "
                            "(SELECT max(o_totalprice) AS m FROM orders GROUP BY o_orderpriority)")
def tree_aggregate(spark, sf):
    """Same result, reduced in two levels (hash sub-slices first)."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_totalprice")
    out = A.tree_total(o, "o_orderpriority", "o_totalprice")
    return out.select(F.round("result", 2).alias("result"))


@plan("partition_max_sum_physical", sql="SELECT max(o_totalprice) AS top, true AS between_one_and_five_tops FROM orders")
def partition_max_sum_physical(spark, sf):
    """Sum over five physical partitions of the partition maximum. It depends on the layout; by the largest value
    it is at least that and at most five times that."""
    o = read_table(spark, sf, "orders", "o_totalprice").repartition(5)
    parts = o.groupBy(F.spark_partition_id().alias("pid")).agg(F.max("o_totalprice").alias("part"))
    return parts.agg(F.max("part").alias("top"), F.sum("part").alias("result")).select(
        "top", F.col("result").between(F.col("top"), 5 * F.col("top")).alias("between_one_and_five_tops"))


@plan("reduce_shortest", sql=f"SELECT first(word ORDER BY length(word), word) AS shortest FROM {WD_}")
def reduce_shortest(spark, sf):
    """Shortest word of all documents (ties: smallest text)."""
    return words(spark, sf).agg(A.shortest("word").alias("shortest"))


def _side_metric(spark, df, metric):
    """The metric as the pass over ``df`` gathers it; the rows themselves go to a sink that drops them."""
    observed, seen = A.observe_metrics(df, "side", metric.alias("metric"))
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["metric"],)], "metric long")


@plan("metric_sum_where", sql=f"SELECT CAST(sum(CASE WHEN dest = 'NATION_5' OR origin = 'NATION_5' "
                              f"THEN cnt END) AS BIGINT) AS metric FROM {FL_}")
def metric_sum_where(spark, sf):
    """Side metric: traffic from or to one nation."""
    c = (F.col("dest") == "NATION_5") | (F.col("origin") == "NATION_5")
    return _side_metric(spark, flights(spark, sf), F.sum(F.when(c, F.col("cnt"))))


@plan("metric_sum_even", sql=f"SELECT CAST(sum(CASE WHEN cnt % 2 = 0 THEN cnt END) AS BIGINT) AS metric FROM {FL_}")
def metric_sum_even(spark, sf):
    """Side metric with its own rule: sum of even counts."""
    return _side_metric(spark, flights(spark, sf), F.sum(F.when(F.col("cnt") % 2 == 0, F.col("cnt"))))


@plan("metric_rows", sql=f"SELECT dest, CAST(sum(cnt) AS BIGINT) AS total, CAST(NULL AS BIGINT) AS even, CAST(NULL AS BIGINT) AS pairs FROM {FL_} GROUP BY dest "
                         f"UNION ALL SELECT NULL, NULL, CAST(sum(cnt) FILTER (cnt % 2 = 0) AS BIGINT), count(*) FROM {FL_}")
def metric_rows(spark, sf):
    """Totals per destination and, from the same pass over the flights, a row of side metrics: the sum of even counts, and the pairs seen."""
    seen = MR.with_metric_rows(flights(spark, sf), {"even": F.when(F.col("cnt") % 2 == 0, F.col("cnt")), "pairs": F.lit(1)})
    return seen.groupBy("dest").agg(F.sum("cnt").alias("total"), F.sum("metric.even").alias("even"), F.sum("metric.pairs").alias("pairs"))


_DESCRIBED = {"count": "count({c})", "mean": "avg({c})", "stddev": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}


@plan("describe_text", sql=_r("l_quantity", "p_retailprice", "n_name") + " UNION ALL ".join(
      f"SELECT '{s}' AS summary, " + ", ".join(f"round(CAST({e.format(c=c)} AS DOUBLE), 6) AS {c}" for c in ("l_quantity", "p_retailprice")) +
      f", {'CAST(count(n_name) AS VARCHAR)' if s == 'count' else e.format(c='n_name') if s in ('min', 'max') else 'NULL'} AS n_name FROM retail"
      for s, e in _DESCRIBED.items()))
def describe_text(spark, sf):
    """Spark's own ``describe()``: count, mean, stddev, min, max per column; its texts of numbers read back as numbers."""
    d = retail(spark, sf, "l_quantity", "p_retailprice", "n_name").describe()
    return d.select("summary", *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("l_quantity", "p_retailprice")], "n_name")
