"""Projection and filter plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import filters as FL
from ..operators import project as P
from ..sources.fixtures import WORDS_SQL, retail, retail_sql, retail_variants, retail_variants_sql, words
from ..sources.tables import read_table
from .registry import plan
from .sqlutil import discount_sql

WD_ = f"({WORDS_SQL})"


def _retail_cte(*cols: str) -> str:
    return f"WITH retail AS ({retail_sql(*cols)}) "


def _variants_cte(*cols: str, variants=("l_partkey", "l_quantity", "p_retailprice", "l_shipdate")) -> str:
    have = [v for v in variants if v in cols]
    return (f"WITH base AS ({retail_sql(*cols)}), "
            f"retail AS (SELECT *, {retail_variants_sql(have)} FROM base) ")


# --- projections -------------------------------------------------------------

def _orders(spark, sf):
    return read_table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


O_ = "(SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders)"


@plan("select_names", sql="SELECT o_orderkey, o_orderpriority FROM orders")
def select_names(spark, sf):
    """Project by name."""
    return P.select_names(_orders(spark, sf), "o_orderkey", "o_orderpriority")


@plan("select_column", sql="SELECT o_custkey FROM orders")
def select_column(spark, sf):
    """Project by Column object."""
    return P.select_columns(_orders(spark, sf), F.col("o_custkey"))


@plan("select_computed", sql="SELECT o_orderkey % 8 AS shard FROM orders")
def select_computed(spark, sf):
    """Project an arithmetic expression."""
    return P.select_columns(_orders(spark, sf), (F.col("o_orderkey") % 8).alias("shard"))


@plan("select_expr", sql="SELECT o_orderkey % 8 AS shard, o_orderpriority AS urgency FROM orders")
def select_expr(spark, sf):
    """Project SQL text expressions with aliases."""
    return P.select_exprs(_orders(spark, sf), "o_orderkey % 8 AS shard", "o_orderpriority AS urgency")


@plan("select_star_plus", sql=f"SELECT *, round(o_totalprice / 1000, 1) AS thousands FROM {O_}")
def select_star_plus(spark, sf):
    """All columns plus a computed one."""
    return P.select_star_plus(_orders(spark, sf), thousands="round(o_totalprice / 1000, 1)")


@plan("select_literal", sql="SELECT o_orderkey, 'order' AS kind, 0.25 AS rate, TIMESTAMP '1997-11-05 06:07:08' AS loaded_at, "
                            "['a', 'b'] AS tags, CAST(NULL AS INTEGER) AS unset FROM orders")
def select_literal(spark, sf):
    """Constant columns: text, number, timestamp, array, null."""
    return _orders(spark, sf).select(
        "o_orderkey", F.lit("order").alias("kind"), F.expr("0.25D AS rate"),
        F.lit("1997-11-05 06:07:08").cast("timestamp_ntz").alias("loaded_at"),
        F.lit(["a", "b"]).alias("tags"), F.lit(None).cast("int").alias("unset"))


@plan("with_column", sql=f"SELECT *, 'open' AS state, o_custkey + 100 AS account FROM {O_}")
def with_column(spark, sf):
    """Add columns."""
    return P.with_columns(_orders(spark, sf), {"state": F.lit("open"), "account": F.col("o_custkey") + 100})


@plan("replace_column", sql="SELECT o_orderkey, o_custkey, round(o_totalprice) AS o_totalprice, o_orderpriority FROM orders")
def replace_column(spark, sf):
    """Overwrite a column of the same name."""
    return P.with_columns(_orders(spark, sf), {"o_totalprice": F.round("o_totalprice")})


@plan("rename_column", sql="SELECT o_orderkey, o_custkey AS buyer, o_totalprice, o_orderpriority FROM orders")
def rename_column(spark, sf):
    """Rename."""
    return P.rename_columns(_orders(spark, sf), {"o_custkey": "buyer"})


@plan("drop_column", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_column(spark, sf):
    """Remove a column."""
    return P.drop_columns(_orders(spark, sf), "o_orderpriority")


@plan("cast_column", sql="SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def cast_column(spark, sf):
    """Change a type."""
    return P.cast_columns(_orders(spark, sf), {"o_orderkey": "string"})


@plan("alias_column", sql="SELECT o_orderkey AS id, o_totalprice AS amount FROM orders")
def alias_column(spark, sf):
    """Name expressions."""
    return _orders(spark, sf).select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))


@plan("case_when", sql=_retail_cte("l_orderkey", "l_partkey", "l_quantity", "p_retailprice") +
      "SELECT l_orderkey, l_partkey, l_quantity, "
      f"round({discount_sql('l_quantity', 'p_retailprice')}, 6) AS price FROM retail")
def case_when(spark, sf):
    """A discount from some number of items on."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity", "p_retailprice")
    return r.select("l_orderkey", "l_partkey", "l_quantity",
                    F.round(P.discounted_price("l_quantity", "p_retailprice"), 6).alias("price"))


MARKS = ("large", "small", "old")   # words looked for in the part names


@plan("generated_columns", sql=("SELECT " + ", ".join(f"contains(p_name, '{m.upper()}') AS has_{m}" for m in MARKS) +
                                ", * FROM (SELECT p_partkey, upper(p_name) AS p_name FROM part)"))
def generated_columns(spark, sf):
    """One flag column per word, followed by all columns."""
    prod = read_table(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", F.upper("p_name").alias("p_name"))
    return P.flag_columns(prod, "p_name", MARKS, prefix="has_")


@plan("row_id", sql=f"SELECT *, 1 AS n_with_id FROM {O_}")
def row_id(spark, sf):
    """Unique, increasing, non-consecutive id per row: every row with the number of rows that have its id."""
    rows = P.with_row_id(_orders(spark, sf))
    names = [c for c in rows.columns if c != "row_id"]
    return rows.groupBy("row_id").agg(*[F.first(c).alias(c) for c in names], F.count(F.lit(1)).cast("int").alias("n_with_id")).drop("row_id")


@plan("pack_struct", sql=f"SELECT * FROM {O_}")
def pack_struct(spark, sf):
    """Whole row packed into one struct and read back through its fields."""
    return P.unpack_struct(P.pack_struct(_orders(spark, sf), "rec"), "rec")


@plan("column_binding", sql="SELECT o_orderkey, o_totalprice / 100 > o_custkey AS rich FROM orders")
def column_binding(spark, sf):
    """Frame-bound and late-bound column references in one expression."""
    o = _orders(spark, sf)
    return o.select(o["o_orderkey"], (o["o_totalprice"] / 100 > F.col("o_custkey")).alias("rich"))


@plan("map_rows", sql=f"SELECT '!!' || word || '!!' AS wrapped, count(*) AS n FROM {WD_} GROUP BY 1")
def map_rows(spark, sf):
    """Every word of every document mapped to '!!word!!' (then counted)."""
    w = words(spark, sf)
    return w.groupBy(P.wrap_text("word").alias("wrapped")).agg(F.count(F.lit(1)).alias("n"))


@plan("flat_map_rows", sql=(f"SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(lower(word), '')) AS ch "
                            f"FROM {WD_}) WHERE length(ch) > 0 GROUP BY ch"))
def flat_map_rows(spark, sf):
    """Every word flat-mapped to its lower-case characters (then counted)."""
    return P.explode_chars(words(spark, sf), "word").groupBy("ch").agg(F.count(F.lit(1)).alias("n"))


# --- filters -------------------------------------------------------------------

@plan("where_sql", sql=f"SELECT * FROM {O_} WHERE o_totalprice < 150000")
def where_sql(spark, sf):
    """SQL text predicate."""
    return FL.where_sql(_orders(spark, sf), "o_totalprice < 150000")


@plan("where_eq", sql=f"SELECT * FROM {O_} WHERE o_orderpriority = '1-URGENT' AND o_custkey <> 7")
def where_eq(spark, sf):
    """Equality and inequality."""
    return _orders(spark, sf).where((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_custkey") != 7))


@plan("filter_column", sql=f"SELECT * FROM {O_} WHERE o_totalprice >= 150000")
def filter_column(spark, sf):
    """Column predicate."""
    return _orders(spark, sf).filter(F.col("o_totalprice") >= 150000)


@plan("filter_lambda", sql=f"SELECT * FROM {O_} WHERE o_custkey % 3 = 1")
def filter_lambda(spark, sf):
    """Host-language predicate, vectorised over Arrow batches."""
    return FL.filter_vectorized(_orders(spark, sf), lambda c: c % 3 == 1, "o_custkey")


@plan("where_or", sql=f"SELECT * FROM {O_} WHERE o_totalprice > 300000 OR o_totalprice < 50000")
def where_or(spark, sf):
    """Disjunction."""
    return FL.where_any(_orders(spark, sf), F.col("o_totalprice") > 300000, F.col("o_totalprice") < 50000)


@plan("where_chain", sql=f"SELECT * FROM {O_} WHERE o_totalprice < 200000 AND o_orderpriority <> '5-LOW'")
def where_chain(spark, sf):
    """Conjunction by chaining (one Filter after optimisation)."""
    return FL.where_all(_orders(spark, sf), F.col("o_totalprice") < 200000, F.col("o_orderpriority") != "5-LOW")


@plan("named_predicate", sql=_retail_cte("l_orderkey", "l_partkey", "l_quantity", "n_name") +
      "SELECT l_orderkey, l_partkey, l_quantity FROM retail WHERE n_name = 'NATION_3'")
def named_predicate(spark, sf):
    """Predicate held in a variable."""
    in_country = F.col("n_name") == "NATION_3"
    return retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity", "n_name").where(in_country) \
        .select("l_orderkey", "l_partkey", "l_quantity")


@plan("bool_column", sql="SELECT p_partkey, p_size, p_size > 25 AS bulky FROM part")
def bool_column(spark, sf):
    """Predicate as a column."""
    part = read_table(spark, sf, "part", "p_partkey", "p_size")
    return part.withColumn("bulky", F.col("p_size") > 25)


@plan("eq_null_safe", sql=_variants_cte("l_partkey", "l_quantity") +
      "SELECT (l_partkey_opt IS NOT DISTINCT FROM '17') AS null_safe, (l_partkey_opt = '17') AS plain, "
      "count(*) AS n FROM retail GROUP BY 1, 2")
def eq_null_safe(spark, sf):
    """Null-safe against ordinary equality on a column with nulls."""
    r = retail_variants(retail(spark, sf, "l_partkey", "l_quantity"))
    return r.groupBy(F.col("l_partkey_opt").eqNullSafe("17").alias("null_safe"),
                     (F.col("l_partkey_opt") == "17").alias("plain")).agg(F.count(F.lit(1)).alias("n"))


@plan("eq_three_valued", sql=_variants_cte("l_orderkey", "l_partkey", "l_quantity") +
      "SELECT l_orderkey, l_partkey_opt FROM retail WHERE l_partkey_opt = '17'")
def eq_three_valued(spark, sf):
    """Ordinary equality: rows where the comparison is null are dropped."""
    r = retail_variants(retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity"))
    return r.where(F.col("l_partkey_opt") == "17").select("l_orderkey", "l_partkey_opt")


@plan("is_null", sql=_variants_cte("l_partkey", "l_quantity") +
      "SELECT l_orderkey_n AS n FROM (SELECT count(*) AS l_orderkey_n FROM retail WHERE l_partkey_opt IS NULL)")
def is_null(spark, sf):
    """Rows whose value is null."""
    r = retail_variants(retail(spark, sf, "l_partkey", "l_quantity"))
    return r.where(F.col("l_partkey_opt").isNull()).agg(F.count(F.lit(1)).alias("n"))


@plan("is_not_null", sql=_variants_cte("l_orderkey", "l_partkey", "l_quantity") +
      "SELECT l_orderkey, l_partkey_opt FROM retail WHERE l_partkey_opt IS NOT NULL")
def is_not_null(spark, sf):
    """Rows whose value is present."""
    r = retail_variants(retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity"))
    return r.where(F.col("l_partkey_opt").isNotNull()).select("l_orderkey", "l_partkey_opt")


@plan("contains", sql="SELECT p_partkey, upper(p_name) AS p_name FROM part "
                      "WHERE contains(upper(p_name), 'RED')")
def contains(spark, sf):
    """Substring predicate."""
    part = read_table(spark, sf, "part", "p_partkey", "p_name")
    d = part.select("p_partkey", F.upper("p_name").alias("p_name"))
    return d.where(F.col("p_name").contains("RED"))


@plan("starts_with", sql=f"SELECT word, count(*) AS n FROM {WD_} WHERE starts_with(word, 'f') GROUP BY word")
def starts_with(spark, sf):
    """Prefix predicate over all words (then counted)."""
    w = words(spark, sf)
    return w.where(F.col("word").startswith("f")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@plan("length_filter", sql=(
    "SELECT p_partkey, regexp_extract(upper(p_name), 'RED (\\w+)', 1) AS thing FROM part "
    "WHERE length(regexp_extract(upper(p_name), 'RED (\\w+)', 1)) > 0"))
def length_filter(spark, sf):
    """Keep rows with a non-empty extract."""
    part = read_table(spark, sf, "part", "p_partkey", "p_name")
    x = part.select("p_partkey", F.regexp_extract(F.upper("p_name"), r"RED (\w+)", 1).alias("thing"))
    return x.where(F.length("thing") > 0)


@plan("date_compare", sql=_retail_cte("l_shipdate") +
      "SELECT CAST(l_shipdate AS DATE) > DATE '1995-06-17' AS after, "
      "CAST(l_shipdate AS DATE) >= DATE '1995-06-17' AS from_day, "
      "CAST(l_shipdate AS DATE) = DATE '1995-06-17' AS on_day, "
      "CAST(l_shipdate AS DATE) <> DATE '1995-06-17' AS not_on_day, count(*) AS n FROM retail GROUP BY 1, 2, 3, 4")
def date_compare(spark, sf):
    """Dates compared with >, >=, =, <>."""
    d = F.to_date("l_shipdate")
    day = F.lit("1995-06-17").cast("date")
    return retail(spark, sf, "l_shipdate").groupBy(
        (d > day).alias("after"), (d >= day).alias("from_day"), (d == day).alias("on_day"),
        (d != day).alias("not_on_day")).agg(F.count(F.lit(1)).alias("n"))


@plan("ts_literal_compare", sql=_retail_cte("l_orderkey", "l_partkey", "l_shipdate") +
      "SELECT l_orderkey, l_partkey, l_shipdate FROM retail WHERE l_shipdate < TIMESTAMP '1996-01-01 00:00:00'")
def ts_literal_compare(spark, sf):
    """Timestamp filtered against a text literal (pushed into the Parquet scan)."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_shipdate")
    return r.where(F.col("l_shipdate") < FL.ts_literal("1996-01-01 00:00:00"))


@plan("filter_subtotals", sql=_retail_cte("l_shipdate", "l_quantity", "n_name") +
      "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(NULL AS VARCHAR) AS n_name, "
      "CAST(sum(l_quantity) AS BIGINT) AS total_qty, 1 AS gid FROM retail GROUP BY 1")
def filter_subtotals(spark, sf):
    """One level of a rollup (per-month subtotals) selected by grouping id."""
    r = retail(spark, sf, "l_shipdate", "l_quantity", "n_name").withColumn(
        "month", F.trunc(F.to_date("l_shipdate"), "month"))
    ru = A.rollup(r, ["month", "n_name"], F.sum("l_quantity").alias("total_qty"))
    return FL.grouping_level(ru, 1).select("month", "n_name", "total_qty", F.col("gid").cast("int").alias("gid"))


@plan("filter_subtotals_nulls", sql=_retail_cte("l_shipdate", "l_quantity", "n_name") +
      "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(NULL AS VARCHAR) AS n_name, "
      "CAST(sum(l_quantity) AS BIGINT) AS total_qty FROM retail GROUP BY 1")
def filter_subtotals_nulls(spark, sf):
    """The same rollup level selected by its null pattern (data nulls removed before the rollup)."""
    r = retail(spark, sf, "l_shipdate", "l_quantity", "n_name").withColumn(
        "month", F.trunc(F.to_date("l_shipdate"), "month"))
    ru = A.rollup(r, ["month", "n_name"], F.sum("l_quantity").alias("total_qty"), gid=None)
    return ru.where("month IS NOT NULL AND n_name IS NULL").select("month", "n_name", "total_qty")
