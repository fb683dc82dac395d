"""UDF, UDAF and custom-type plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import types as Y
from ..functions import udfs as U
from ..operators import merging as M
from ..operators import nulls as N
from ..operators import udaf
from ..sources.fixtures import retail, retail_sql, retail_variants
from ..sources.files import scratch_path
from ..sources.tables import read_table
from .registry import plan
from .sqlutil import MS, discount_sql, truncate_sql


def _r(*cols):
    return f"WITH retail AS ({retail_sql(*cols)}) "


@plan("udf_scalar", sql="SELECT p_partkey, CAST(p_size AS DOUBLE) * p_size * p_size AS cubed FROM part")
def udf_scalar(spark, sf):
    """Cube of a number through a vectorised (Arrow) UDF."""
    p = read_table(spark, sf, "part", "p_partkey", "p_size")
    return p.select("p_partkey", U.cube_vec(F.col("p_size").cast("double")).alias("cubed"))


@plan("udf_named", sql="SELECT p_partkey, round(p_retailprice * p_retailprice * p_retailprice, 2) AS cubed FROM part")
def udf_named(spark, sf):
    """An existing Python function used as an (Arrow-optimised) UDF."""
    p = read_table(spark, sf, "part", "p_partkey", "p_retailprice")
    return p.select("p_partkey", F.round(U.cube_udf()(F.col("p_retailprice")), 2).alias("cubed"))


@plan("udf_sql", sql="SELECT p_partkey, round(p_retailprice * p_retailprice * p_retailprice, 2) AS cubed, "
                     "round(p_retailprice * p_retailprice * p_retailprice, 2) AS cubed_py FROM part")
def udf_sql(spark, sf):
    """A function registered for SQL text: as a SQL function and as a Python UDF."""
    U.register_cube(spark)
    U.register_cube_python(spark)
    p = read_table(spark, sf, "part", "p_partkey", "p_retailprice")
    return spark.sql("SELECT p_partkey, round(cube_of(p_retailprice), 2) AS cubed, "
                     "round(cube_py(p_retailprice), 2) AS cubed_py FROM {p}", p=p)


DISCOUNT_SQL = f"round({discount_sql('l_quantity', 'p_retailprice')}, 6)"


@plan("udf_two_args", sql=_r("l_orderkey", "l_partkey", "l_quantity", "p_retailprice") +
      f"SELECT l_orderkey, l_partkey, {DISCOUNT_SQL} AS price FROM retail")
def udf_two_args(spark, sf):
    """Discount from two columns through a vectorised UDF."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity", "p_retailprice")
    return r.select("l_orderkey", "l_partkey", F.round(U.discount_vec("l_quantity", "p_retailprice"), 6).alias("price"))


@plan("udf_row", sql=_r("l_orderkey", "l_partkey", "l_quantity", "p_retailprice") +
      f"SELECT l_orderkey, l_partkey, {DISCOUNT_SQL} AS price FROM retail")
def udf_row(spark, sf):
    """Discount from a struct of the needed columns (never the whole row)."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity", "p_retailprice")
    return r.select("l_orderkey", "l_partkey", F.round(U.discount_on_struct(), 6).alias("price"))


@plan("udf_array", sql="SELECT p_partkey, list_transform(range(p_size), lambda x: 0) AS zeros FROM part")
def udf_array(spark, sf):
    """Array-valued function (native form)."""
    p = read_table(spark, sf, "part", "p_partkey", "p_size")
    return p.select("p_partkey", S.zeros("p_size").alias("zeros"))


@plan("udf_map", sql="SELECT p_partkey, CAST(len(list_distinct(string_split(p_name, ' '))) AS INTEGER) AS n, "
                     "CAST(length(string_split(p_name, ' ')[1]) AS INTEGER) AS first_len FROM part")
def udf_map(spark, sf):
    """Map-valued function (native form): word -> length, looked up and sized."""
    p = read_table(spark, sf, "part", "p_partkey", "p_name")
    m = S.word_lengths("p_name")
    return p.select("p_partkey", F.size(m).alias("n"), m[F.split("p_name", " ")[0]].alias("first_len"))


@plan("udf_parameterised", sql="SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS later FROM orders")
def udf_parameterised(spark, sf):
    """Function factory closing over a constant (90 minutes)."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", S.add_minutes_fn(90)("o_orderdate").alias("later"))


@plan("udf_timestamp", sql=f"SELECT o_orderkey, {MS('o_orderdate + INTERVAL 5 MINUTE')} - {MS('o_orderdate')} "
                           f"AS diff_ms FROM orders")
def udf_timestamp(spark, sf):
    """Timestamp in, number out: difference in milliseconds."""
    o = read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", S.diff_millis(S.plus_minutes("o_orderdate", 5), "o_orderdate").alias("diff_ms"))


@plan("udf_null_aware", sql=(
    f"WITH base AS ({retail_sql('l_orderkey', 'l_partkey', 'l_quantity')}), "
    "retail AS (SELECT *, CASE WHEN l_quantity % 4 <> 0 THEN l_partkey END AS l_partkey_opt FROM base) "
    f"SELECT l_orderkey, {truncate_sql('l_partkey_opt')} AS code FROM retail"))
def udf_null_aware(spark, sf):
    """A function that handles null itself."""
    r = retail_variants(retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity"))
    return r.select("l_orderkey", N.truncate_code("l_partkey_opt").alias("code"))


@plan("udaf_columns", sql=_r("l_quantity") + "SELECT 'avg' AS agg, round(avg(l_quantity), 6) AS value FROM retail "
                                           "UNION ALL SELECT 'user_mean', round(avg(l_quantity), 6) FROM retail")
def udaf_columns(spark, sf):
    """Custom mean over a column beside the built-in avg (whole table), one row each."""
    r = retail(spark, sf, "l_quantity")
    mine = udaf.aggregate(r, [], udaf.mean_of("l_quantity")).select(
        F.lit("user_mean").alias("agg"), F.round("mean", 6).alias("value"))
    builtin = r.agg(F.lit("avg").alias("agg"), F.round(F.avg("l_quantity"), 6).alias("value"))
    return builtin.unionByName(mine)


@plan("udaf_rows", sql=_r("l_quantity", "p_retailprice", "n_name") +
      "SELECT n_name, round(sum(p_retailprice * l_quantity) / sum(l_quantity), 6) AS weighted_avg "
      "FROM retail GROUP BY n_name")
def udaf_rows(spark, sf):
    """A user aggregate over several input columns of each row (weighted mean price)."""
    r = retail(spark, sf, "l_quantity", "p_retailprice", "n_name")
    out = udaf.aggregate(r, ["n_name"], udaf.weighted_mean_of("p_retailprice", "l_quantity"))
    return out.select("n_name", F.round("weighted_avg", 6).alias("weighted_avg"))


@plan("udaf_merged_top", sql=_r("l_orderkey", "l_partkey", "l_quantity", "n_name") +
      "SELECT n_name, list(l_quantity || '|' || l_orderkey || '|' || l_partkey ORDER BY l_quantity DESC, l_orderkey, l_partkey)[1:5] AS top "
      "FROM retail GROUP BY n_name")
def udaf_merged_top(spark, sf):
    """A user aggregate with an opaque state and its own merge, in three levels: per country the five largest line items."""
    r = retail(spark, sf, "l_orderkey", "l_partkey", "l_quantity", "n_name")
    return M.merge_aggregate(r, ["n_name"], M.TopK(5, "l_quantity", "l_orderkey", "l_partkey"), "top", depth=3)


@plan("udaf_typed", sql=_r("l_quantity", "n_name") +
      "SELECT n_name, round(avg(l_quantity), 6) AS avg_qty, round(avg(l_quantity), 6) AS user_mean "
      "FROM retail GROUP BY n_name")
def udaf_typed(spark, sf):
    """Per country: built-in avg and the custom mean."""
    r = retail(spark, sf, "l_quantity", "n_name")
    mine = udaf.aggregate(r, ["n_name"], udaf.mean_of("l_quantity"))
    builtin = r.groupBy("n_name").agg(F.avg("l_quantity").alias("avg_qty"))
    return builtin.join(mine, "n_name").select("n_name", F.round("avg_qty", 6).alias("avg_qty"),
                                                F.round("mean", 6).alias("user_mean"))


@plan("instant_ms_column", sql=f"SELECT event_id, make_timestamp({MS('ts')} * 1000) AS instant FROM events")
def instant_ms_column(spark, sf):
    """An instant column with millisecond precision."""
    ev = read_table(spark, sf, "events", "event_id", "ts")
    return ev.select("event_id", S.truncate_to_millis("ts").alias("instant"))


@plan("opaque_column", sql="SELECT p_partkey, hex(encode(p_name)) AS stored_hex, 'restored: ' || p_name AS restored "
                          "FROM part")
def opaque_column(spark, sf):
    """A text object stored as bytes (shown as hex) and restored."""
    p = read_table(spark, sf, "part", "p_partkey", "p_name")
    stored = p.select("p_partkey", S.to_bytes("p_name").alias("stored"))
    return stored.select("p_partkey", F.hex("stored").alias("stored_hex"), S.restore_text("stored").alias("restored"))


@plan("instant_type_stored", sql=f"SELECT event_id, {MS('ts')} AS stored, make_timestamp({MS('ts')} * 1000) AS instant FROM events")
def instant_type_stored(spark, sf):
    """An instant as a type of its own, written to Parquet and read back as that type: what is stored, and the object restored."""
    ev = read_table(spark, sf, "events", "event_id", "ts").select("event_id", Y.instant("ts").alias("instant"))
    path = scratch_path(spark, "instants")
    ev.write.parquet(path)
    back = spark.read.parquet(path)
    if not isinstance(back.schema["instant"].dataType, Y.InstantType):
        raise TypeError("instant_type_stored: the type was not restored")
    moment = F.udf(lambda t: t, "timestamp_ntz", useArrow=True)
    return back.select("event_id", Y.stored_millis("instant").alias("stored"), moment("instant").alias("instant"))


@plan("opaque_type_stored", sql="SELECT p_partkey, p_name, p_size FROM part")
def opaque_type_stored(spark, sf):
    """Objects in a type of its own, written to Parquet as bytes, read back as objects and asked for their fields."""
    p = read_table(spark, sf, "part", "p_partkey", "p_name", "p_size")
    path = scratch_path(spark, "objects")
    p.select("p_partkey", Y.opaque("p_name", "p_size").alias("object")).write.parquet(path)
    back = spark.read.parquet(path)
    return back.select("p_partkey", Y.restored_field("object", "p_name", "string").alias("p_name"),
                       Y.restored_field("object", "p_size", p.schema["p_size"].dataType).alias("p_size"))
