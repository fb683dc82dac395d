"""Fixture tables derived from the driver tables.

Each fixture exists twice from one specification: as a Spark DataFrame and as
portable SQL text (used as a ``WITH`` clause by the DuckDB oracle). Both read
the whole base tables, so their work grows with the data.

``retail`` joins only the tables that the requested columns need. The lineitem
foreign keys (order, part, customer, nation) are total, so leaving out a join
whose columns are not used does not change the rows; the SQL text is built
from the same column set, so both sides always join the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# ---------------------------------------------------------------------------
# retail: one row per lineitem
# ---------------------------------------------------------------------------

# column -> (group of tables it needs, Spark expression factory, SQL expression)
_RETAIL = {
    "l_orderkey": ("l", lambda: F.col("l_orderkey").cast("string"), "CAST(l_orderkey AS VARCHAR)"),
    "l_partkey": ("l", lambda: F.col("l_partkey").cast("string"), "CAST(l_partkey AS VARCHAR)"),
    "p_name": ("p", lambda: F.upper("p_name"), "upper(p_name)"),
    "l_quantity": ("l", lambda: F.col("l_quantity").cast("int"), "CAST(l_quantity AS INTEGER)"),
    "l_shipdate": ("l", lambda: F.col("l_shipdate"), "l_shipdate"),
    "p_retailprice": ("p", lambda: F.col("p_retailprice"), "p_retailprice"),
    "o_custkey": ("o", lambda: F.when(F.col("o_custkey") % 10 == 0, F.lit(None).cast("double"))
                   .otherwise(F.col("o_custkey").cast("double")),
                   "CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END"),
    "n_name": ("c", lambda: F.col("n_name"), "n_name"),
}
RETAIL_COLUMNS = tuple(_RETAIL)


def _retail_groups(cols) -> set[str]:
    groups = {_RETAIL[c][0] for c in cols}
    if "c" in groups:
        groups.add("o")
    return groups


def retail(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    cols = cols or RETAIL_COLUMNS
    groups = _retail_groups(cols)
    li_cols = ["l_orderkey", "l_partkey", "l_quantity", "l_shipdate"]
    df = read_table(spark, sf_dir, "lineitem", *li_cols)
    if "o" in groups:
        orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
        if "c" in groups:
            # Order-sized join first: customer and its nation are attached to
            # orders before the lineitem-sized join, so the big side is
            # shuffled once per key instead of once per dimension.
            cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
            nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
            cust = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
            orders = orders.join(cust, orders.o_custkey == cust.c_custkey)
        df = df.join(orders, df.l_orderkey == orders.o_orderkey)
    if "p" in groups:
        part = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice")
        df = df.join(part, df.l_partkey == part.p_partkey)
    return df.select(*[_RETAIL[c][1]().alias(c) for c in cols])


def retail_sql(*cols: str) -> str:
    cols = cols or RETAIL_COLUMNS
    groups = _retail_groups(cols)
    sel = ", ".join(f"{_RETAIL[c][2]} AS {c}" for c in cols)
    frm = "lineitem"
    if "o" in groups:
        frm += " JOIN orders ON o_orderkey = l_orderkey"
    if "c" in groups:
        frm += " JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey"
    if "p" in groups:
        frm += " JOIN part ON p_partkey = l_partkey"
    return f"SELECT {sel} FROM {frm}"


def retail_variants(df: DataFrame) -> DataFrame:
    """Add ``l_partkey_opt``/``l_quantity_opt``/``p_retailprice_opt``/``l_shipdate_opt``: the value when
    l_quantity is no multiple of four, else null (the missing-data fixture)."""
    present = F.col("l_quantity") % 4 != 0
    out = df
    for c in ("l_partkey", "l_quantity", "p_retailprice", "l_shipdate"):
        if c in df.columns:
            out = out.withColumn(f"{c}_opt", F.when(present, F.col(c)))
    return out


def retail_variants_sql(cols) -> str:
    return ", ".join(f"CASE WHEN l_quantity % 4 <> 0 THEN {c} END AS {c}_opt" for c in cols)


# ---------------------------------------------------------------------------
# flights: (dest, origin, cnt) per pair of nations, from lineitem traffic
# ---------------------------------------------------------------------------

def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    cust = read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    supp = read_table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    dest_by_order = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                     .select("o_orderkey", F.col("c_nationkey").alias("dest_key")))
    pairs = (li.join(dest_by_order, li.l_orderkey == dest_by_order.o_orderkey)
             .join(supp, li.l_suppkey == supp.s_suppkey)
             # aggregate on the small nation keys before attaching names:
             # the lineitem-sized side is reduced to at most 25 x 25 rows first
             .groupBy("dest_key", F.col("s_nationkey").alias("origin_key"))
             .agg(F.count(F.lit(1)).cast("int").alias("cnt")))
    d = nation.select(F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("dest"))
    o = nation.select(F.col("n_nationkey").alias("origin_key"), F.col("n_name").alias("origin"))
    return pairs.join(d, "dest_key").join(o, "origin_key").select("dest", "origin", "cnt")


FLIGHTS_SQL = (
    "SELECT d.n_name AS dest, o.n_name AS origin, CAST(count(*) AS INTEGER) AS cnt "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey "
    "JOIN customer ON c_custkey = o_custkey JOIN nation d ON d.n_nationkey = c_nationkey "
    "JOIN supplier ON s_suppkey = l_suppkey JOIN nation o ON o.n_nationkey = s_nationkey "
    "GROUP BY d.n_name, o.n_name"
)


# ---------------------------------------------------------------------------
# positions: movement records (vessel id, time, lat, lon) from events
# ---------------------------------------------------------------------------

def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value")
    return ev.select(F.col("user_id").cast("int").alias("mmsi"), "ts",
                     (F.col("value") / 10).alias("lat"), (F.col("value") / 5).alias("lon"),
                     F.col("event_id").alias("seq"))


POSITIONS_SQL = ("SELECT CAST(user_id AS INTEGER) AS mmsi, ts, value / 10 AS lat, value / 5 AS lon, "
                 "event_id AS seq FROM events")


# ---------------------------------------------------------------------------
# words: every blank-separated token of every document, whole texts
# ---------------------------------------------------------------------------

# Whitespace spelled out so that Java (Spark) and RE2 (DuckDB) agree: their
# shorthand \s differs on the vertical tab.
WS = "[ \\t\\n\\x0B\\f\\r]+"

def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    w = docs.select("doc_id", F.posexplode(F.split("text", WS)).alias("pos", "word"))
    return w.where(F.length("word") > 0)


WORDS_SQL = (
    "SELECT doc_id, pos, word FROM ("
    "SELECT doc_id, generate_subscripts(a, 1) - 1 AS pos, unnest(a) AS word FROM ("
    f"SELECT doc_id, regexp_split_to_array(text, '{WS}') AS a FROM documents)) WHERE length(word) > 0"
)


def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key/value table (letter, 1): one row per character of every lower-cased word.

    The words of a text, concatenated, are the text without its whitespace, so
    the characters are taken from the lower-cased text with whitespace removed:
    one split per document instead of one per word (lower-casing the whole text
    sees the same word boundaries as lower-casing each word).
    """
    docs = read_table(spark, sf_dir, "documents", "text")
    chars = F.split(F.regexp_replace(F.lower("text"), WS, ""), "")
    return (docs.select(F.explode(chars).alias("key")).where(F.length("key") > 0)
            .select("key", F.lit(1).alias("value")))


LETTERS_SQL = (
    f"SELECT key, 1 AS value FROM (SELECT unnest(string_split(lower(word), '')) AS key FROM ({WORDS_SQL}))"
)
