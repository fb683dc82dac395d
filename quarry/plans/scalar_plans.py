"""Scalar function plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import keyvalue as KV
from ..operators import nulls as N
from ..sources.fixtures import FLIGHTS_SQL, WORDS_SQL, flights, retail, retail_sql, retail_variants, retail_variants_sql, words
from ..sources.tables import read_table
from .registry import plan
from .sqlutil import MS, truncate_sql

FL_ = f"({FLIGHTS_SQL})"
WD_ = f"({WORDS_SQL})"


def _parts(spark, sf):
    return read_table(spark, sf, "part", "p_partkey", "p_name", "p_size", "p_retailprice")


def _orders(spark, sf):
    return read_table(spark, sf, "orders", "o_orderkey", "o_orderdate")


def _variants(spark, sf, *cols):
    return retail_variants(retail(spark, sf, *cols))


def _vsql(cols, variants) -> str:
    return f"WITH base AS ({retail_sql(*cols)}), retail AS (SELECT *, {retail_variants_sql(variants)} FROM base) "


# --- math ----------------------------------------------------------------------

@plan("arithmetic", sql="SELECT p_partkey, p_size * 2 AS twice, p_size + 7 AS more, p_size % 4 AS rest, "
                        "100 - p_size AS short_of_hundred FROM part")
def arithmetic(spark, sf):
    """+ - * % on columns."""
    size = F.col("p_size")
    return _parts(spark, sf).select("p_partkey", (size * 2).alias("twice"), (size + 7).alias("more"),
                                    (size % 4).alias("rest"), (100 - size).alias("short_of_hundred"))


@plan("power", sql="SELECT p_partkey, round(power(p_retailprice / 1000, 3), 6) AS cubed, "
                   "round(power(p_size, 0.5), 6) AS root FROM part")
def power(spark, sf):
    """Power, Column and SQL spelling."""
    return _parts(spark, sf).select("p_partkey", F.round(F.pow(F.col("p_retailprice") / 1000, 3), 6).alias("cubed"),
                                    F.round(F.expr("POWER(p_size, 0.5)"), 6).alias("root"))


@plan("round_half_up", sql="SELECT p_partkey, round(p_retailprice, 1) AS r1, round(-p_retailprice, 1) AS r1_neg, "
                           "round(p_retailprice) AS r0 FROM part")
def round_half_up(spark, sf):
    """Round half away from zero."""
    p = _parts(spark, sf)
    return p.select("p_partkey", S.round_half_up("p_retailprice", 1).alias("r1"),
                    S.round_half_up(-F.col("p_retailprice"), 1).alias("r1_neg"),
                    S.round_half_up("p_retailprice", 0).alias("r0"))


# --- text ----------------------------------------------------------------------

INITCAP_SQL = ("array_to_string(list_transform(string_split(lower(p_name), ' '), "
               "lambda w: upper(w[1]) || w[2:]), ' ')")


@plan("case_functions", sql=f"SELECT p_partkey, upper(p_name) AS up, lower(upper(p_name)) AS low, "
                            f"{INITCAP_SQL} AS title FROM part")
def case_functions(spark, sf):
    """Upper, lower and title case."""
    p = _parts(spark, sf)
    return p.select("p_partkey", F.upper("p_name").alias("up"), F.lower(F.upper("p_name")).alias("low"),
                    S.title_case("p_name").alias("title"))


@plan("trim", sql="SELECT p_partkey, trim('  ' || p_name || '  ') AS trimmed FROM part")
def trim(spark, sf):
    """Strip blanks on both sides."""
    return _parts(spark, sf).select("p_partkey", F.trim(F.concat(F.lit("  "), "p_name", F.lit("  "))).alias("trimmed"))


@plan("ltrim_rtrim", sql="SELECT p_partkey, ltrim('  ' || p_name || '  ') AS l, rtrim('  ' || p_name || '  ') AS r "
                         "FROM part")
def ltrim_rtrim(spark, sf):
    """One-sided trims."""
    padded = F.concat(F.lit("  "), "p_name", F.lit("  "))
    return _parts(spark, sf).select("p_partkey", F.ltrim(padded).alias("l"), F.rtrim(padded).alias("r"))


@plan("lpad", sql="SELECT p_partkey, lpad(p_name, 10, ' ') AS padded, lpad(p_name, 14, '*') AS starred FROM part")
def lpad(spark, sf):
    """Left pad (cuts values longer than the width)."""
    return _parts(spark, sf).select("p_partkey", S.pad_left("p_name", 10).alias("padded"),
                                    S.pad_left("p_name", 14, "*").alias("starred"))


@plan("rpad", sql="SELECT p_partkey, rpad(p_name, 12, '.') AS padded FROM part")
def rpad(spark, sf):
    """Right pad."""
    return _parts(spark, sf).select("p_partkey", S.pad_right("p_name", 12, ".").alias("padded"))


@plan("regexp_replace", sql="SELECT p_partkey, regexp_replace(upper(p_name), 'RED|BLUE', 'color', 'g') AS d "
                            "FROM part")
def regexp_replace(spark, sf):
    """Replace every match of a pattern."""
    return _parts(spark, sf).select("p_partkey", S.replace_pattern(F.upper("p_name"), "RED|BLUE", "color").alias("d"))


@plan("regexp_extract", sql="SELECT p_partkey, regexp_extract(upper(p_name), '(RED|BLUE) (\\w+)', 2) AS thing "
                            "FROM part")
def regexp_extract(spark, sf):
    """Capture group; '' when there is no match."""
    return _parts(spark, sf).select("p_partkey",
                                    S.extract_group(F.upper("p_name"), r"(RED|BLUE) (\w+)", 2).alias("thing"))


@plan("length", sql=f"SELECT CAST(length(word) AS INTEGER) AS len, count(*) AS n FROM {WD_} GROUP BY 1")
def length(spark, sf):
    """Text length of every word (then counted per length)."""
    return words(spark, sf).groupBy(F.length("word").alias("len")).agg(F.count(F.lit(1)).alias("n"))


@plan("split", sql="SELECT p_partkey, string_split(upper(p_name), ' ') AS arr FROM part")
def split(spark, sf):
    """Split on blank to an array."""
    return _parts(spark, sf).select("p_partkey", S.words_of(F.upper("p_name")).alias("arr"))


@plan("truncate_code", sql=_vsql(("l_orderkey", "l_partkey", "l_quantity"), ["l_partkey"]) +
      "SELECT l_orderkey, l_partkey_opt, " + truncate_sql("l_partkey_opt") + " AS code "
      "FROM retail")
def truncate_code(spark, sf):
    """A code for the missing, a marker behind the first characters of the long."""
    r = _variants(spark, sf, "l_orderkey", "l_partkey", "l_quantity")
    return r.select("l_orderkey", "l_partkey_opt", N.truncate_code("l_partkey_opt").alias("code"))


# --- dates and times ---------------------------------------------------------------

@plan("now", sql="SELECT event_id, true AS same_day, true AS after_the_event FROM events")
def now(spark, sf):
    """Current date and timestamp beside each event (constant within one query): the date is the timestamp's, and
    both are later than the event."""
    ev = read_table(spark, sf, "events", "event_id", "ts")
    return ev.select("event_id", (F.current_date() == F.to_date(F.current_timestamp())).alias("same_day"),
                     (F.current_timestamp() > F.col("ts").cast("timestamp")).alias("after_the_event"))


@plan("to_date", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, "
                     "CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS d_text FROM orders")
def to_date(spark, sf):
    """Timestamp or text to date."""
    o = _orders(spark, sf)
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("d"),
                    F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("d_text"))


@plan("to_timestamp", sql="SELECT o_orderkey, strptime(strftime(o_orderdate, '%d.%m.%Y %H:%M:%S'), "
                          "'%d.%m.%Y %H:%M:%S') AS custom, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') "
                          "AS TIMESTAMP) AS plain, CAST(NULL AS TIMESTAMP) AS bad FROM orders")
def to_timestamp(spark, sf):
    """Text to timestamp with the default and a custom pattern; unparsable text gives null."""
    o = _orders(spark, sf)
    return o.select("o_orderkey",
                    S.parse_timestamp(F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss"), "dd.MM.yyyy HH:mm:ss")
                    .alias("custom"),
                    S.parse_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("plain"),
                    S.parse_timestamp(F.concat(F.lit("x"), F.col("o_orderkey").cast("string")),
                                      "dd.MM.yyyy HH:mm:ss").alias("bad"))


@plan("date_add_sub", sql="SELECT o_orderkey, CAST(o_orderdate AS DATE) + 5 AS plus5, "
                          "CAST(o_orderdate AS DATE) - 7 AS minus7 FROM orders")
def date_add_sub(spark, sf):
    """Shift dates by days."""
    d = F.to_date("o_orderdate")
    return _orders(spark, sf).select("o_orderkey", F.date_add(d, 5).alias("plus5"), F.date_sub(d, 7).alias("minus7"))


@plan("ts_plus_interval", sql="SELECT o_orderkey, o_orderdate + INTERVAL 5 MINUTE AS plus5, "
                              "strftime(o_orderdate + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS plus5_text, "
                              "o_orderdate + INTERVAL 5 MINUTE AS plus5_fn FROM orders")
def ts_plus_interval(spark, sf):
    """Add minutes: interval literal, epoch seconds (text result), parameterised function.

    The epoch-seconds spelling renders its text in the session time zone (UTC here)."""
    o = _orders(spark, sf)
    add5 = S.add_minutes_fn(5)
    return o.select("o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 5 MINUTES")).alias("plus5"),
                    S.plus_minutes_via_epoch("o_orderdate", 5).alias("plus5_text"),
                    add5("o_orderdate").alias("plus5_fn"))


@plan("unix_roundtrip", sql="SELECT o_orderkey, epoch_us(o_orderdate) // 1000000 AS epoch_s, "
                            "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS back FROM orders")
def unix_roundtrip(spark, sf):
    """Epoch seconds and back to text (rendered in the session time zone, UTC here)."""
    o = _orders(spark, sf)
    e = F.unix_timestamp("o_orderdate")
    return o.select("o_orderkey", e.alias("epoch_s"), F.from_unixtime(e).alias("back"))


@plan("datediff", sql="SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), "
                      "CAST(o_orderdate AS DATE) - 7) AS INTEGER) AS week_back, "
                      "CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS since FROM orders")
def datediff(spark, sf):
    """Days between dates, end minus start."""
    d = F.to_date("o_orderdate")
    return _orders(spark, sf).select("o_orderkey", F.datediff(F.date_sub(d, 7), d).alias("week_back"),
                                     F.datediff(d, F.lit("1995-01-01").cast("date")).alias("since"))


@plan("diff_seconds", sql="SELECT event_id, epoch_us(ts) // 1000000 - epoch_us(date_trunc('day', ts)) // 1000000 "
                          "AS secs FROM events")
def diff_seconds(spark, sf):
    """Difference in seconds."""
    ev = read_table(spark, sf, "events", "event_id", "ts")
    day_start = F.to_date("ts").cast("timestamp_ntz")     # zone-free for TIMESTAMP_NTZ
    return ev.select("event_id", S.diff_seconds("ts", day_start).alias("secs"))


_DAY_START = "date_trunc('day', ts)"


@plan("diff_millis", sql=f"SELECT event_id, {MS('ts')} - {MS(_DAY_START)} AS ms FROM events")
def diff_millis(spark, sf):
    """Difference in milliseconds."""
    ev = read_table(spark, sf, "events", "event_id", "ts")
    day_start = F.to_date("ts").cast("timestamp_ntz")
    return ev.select("event_id", S.diff_millis("ts", day_start).alias("ms"))


# --- arrays ----------------------------------------------------------------------

@plan("array_literal", sql=f"SELECT dest, origin, [1, 2, 3] AS arr FROM {FL_}")
def array_literal(spark, sf):
    """Constant array column."""
    return flights(spark, sf).select("dest", "origin", F.array(F.lit(1), F.lit(2), F.lit(3)).alias("arr"))


@plan("array_element", sql="SELECT p_partkey, string_split(p_name, ' ')[2] AS second, "
                           "string_split(p_name, ' ')[6] AS sixth FROM part")
def array_element(spark, sf):
    """Element by 0-based index; out of range gives null."""
    arr = F.split("p_name", " ")
    return _parts(spark, sf).select("p_partkey", S.element(arr, 1).alias("second"), S.element(arr, 5).alias("sixth"))


@plan("array_size", sql="SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n FROM part")
def array_size(spark, sf):
    """Array length."""
    return _parts(spark, sf).select("p_partkey", F.size(F.split("p_name", " ")).alias("n"))


@plan("array_contains", sql="SELECT p_partkey, list_contains(string_split(upper(p_name), ' '), 'RED') AS has_red "
                            "FROM part")
def array_contains(spark, sf):
    """Membership."""
    return _parts(spark, sf).select("p_partkey",
                                    F.array_contains(F.split(F.upper("p_name"), " "), "RED").alias("has_red"))


@plan("explode_array", sql="SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_array(spark, sf):
    """One row per element."""
    return _parts(spark, sf).select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@plan("array_of_zeros", sql="SELECT p_partkey, list_transform(range(p_size), lambda x: 0) AS zeros FROM part")
def array_of_zeros(spark, sf):
    """Array of n zeros from a column."""
    return _parts(spark, sf).select("p_partkey", S.zeros("p_size").alias("zeros"))


# --- maps ------------------------------------------------------------------------

@plan("map_create", sql="SELECT p_partkey, map_keys(MAP([p_name], [p_partkey])) AS k, "
                        "map_values(MAP([p_name], [p_partkey])) AS v FROM part")
def map_create(spark, sf):
    """Map from two columns (shown as its keys and values)."""
    m = S.pair_map("p_name", "p_partkey")
    return _parts(spark, sf).select("p_partkey", F.map_keys(m).alias("k"), F.map_values(m).alias("v"))


WL_KEYS = "list_sort(list_distinct(string_split(p_name, ' ')))"


@plan("map_word_length", sql=f"SELECT p_partkey, {WL_KEYS} AS words, "
                             f"list_transform({WL_KEYS}, lambda w: CAST(length(w) AS INTEGER)) AS lengths FROM part")
def map_word_length(spark, sf):
    """Word -> length map of a text (shown as sorted keys and their values)."""
    m = S.word_lengths("p_name")
    ks = F.array_sort(F.map_keys(m))
    return _parts(spark, sf).select("p_partkey", ks.alias("words"),
                                    F.transform(ks, lambda k: m[k]).alias("lengths"))


@plan("map_size", sql="SELECT p_partkey, CAST(len(list_distinct(string_split(p_name, ' '))) AS INTEGER) AS n FROM part")
def map_size(spark, sf):
    """Entry count of a map."""
    return _parts(spark, sf).select("p_partkey", F.size(S.word_lengths("p_name")).alias("n"))


@plan("map_lookup", sql="SELECT p_partkey, CASE WHEN list_contains(string_split(p_name, ' '), 'red') "
                        "THEN 3 END AS red_len FROM part")
def map_lookup(spark, sf):
    """Value by key; a missing key gives null."""
    return _parts(spark, sf).select("p_partkey", S.word_lengths("p_name")["red"].alias("red_len"))


@plan("explode_map", sql="SELECT w AS key, CAST(length(w) AS INTEGER) AS value, p_partkey FROM "
                         "(SELECT unnest(list_distinct(string_split(p_name, ' '))) AS w, p_partkey FROM part)")
def explode_map(spark, sf):
    """One row per map entry: columns ``key`` and ``value`` (word -> length)."""
    return _parts(spark, sf).select(F.explode(S.word_lengths("p_name")).alias("key", "value"), "p_partkey")


@plan("explode_map_keep", sql="SELECT p_partkey, p_name, p_name AS key, p_partkey AS value FROM part")
def explode_map_keep(spark, sf):
    """Map entries exploded beside all other columns."""
    p = read_table(spark, sf, "part", "p_partkey", "p_name")
    return p.select("*", F.explode(S.pair_map("p_name", "p_partkey")))


# --- missing data ----------------------------------------------------------------

@plan("nullif", sql=_vsql(("l_orderkey", "l_partkey", "l_quantity"), ["l_partkey"]) +
      "SELECT l_orderkey, nullif(l_partkey_opt, '17') AS code FROM retail")
def nullif(spark, sf):
    """A value turned into null."""
    r = _variants(spark, sf, "l_orderkey", "l_partkey", "l_quantity")
    return r.select("l_orderkey", N.null_if("l_partkey_opt", "17").alias("code"))


_NV = ("l_orderkey", "l_partkey", "l_quantity", "p_retailprice", "l_shipdate")
_NVV = ["l_partkey", "l_quantity", "p_retailprice", "l_shipdate"]


@plan("drop_any", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, l_partkey_opt, l_quantity_opt, p_retailprice_opt, l_shipdate_opt FROM retail "
      "WHERE l_partkey_opt IS NOT NULL AND l_quantity_opt IS NOT NULL AND p_retailprice_opt IS NOT NULL "
      "AND l_shipdate_opt IS NOT NULL")
def drop_any(spark, sf):
    """Drop rows with any null."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt", "l_quantity_opt", "p_retailprice_opt", "l_shipdate_opt")
    return N.drop_rows(r, "any")


@plan("drop_all", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, l_partkey_opt, p_retailprice_opt FROM retail WHERE l_partkey_opt IS NOT NULL OR p_retailprice_opt IS NOT NULL")
def drop_all(spark, sf):
    """Drop rows where all of the named columns are null."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt", "p_retailprice_opt")
    return N.drop_rows(r, "all", ["l_partkey_opt", "p_retailprice_opt"])


@plan("coalesce_columns", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, coalesce(l_partkey_opt, CAST(l_quantity AS VARCHAR)) AS first_present, "
      "coalesce(l_partkey_opt, 'none given') AS with_default FROM retail")
def coalesce_columns(spark, sf):
    """First non-null of columns, or a constant."""
    r = _variants(spark, sf, *_NV)
    return r.select("l_orderkey", N.first_non_null("l_partkey_opt", "l_quantity").alias("first_present"),
                    N.first_non_null("l_partkey_opt", default="none given").alias("with_default"))


@plan("fill_string", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, coalesce(l_partkey_opt, 'none given') AS l_partkey_opt, l_quantity_opt FROM retail")
def fill_string(spark, sf):
    """Fill all text columns."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt", "l_quantity_opt")
    return N.fill(r, "none given")


@plan("fill_numeric", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, l_partkey_opt, coalesce(l_quantity_opt, 2) AS l_quantity_opt, coalesce(p_retailprice_opt, 2.75) AS p_retailprice_opt "
      "FROM retail")
def fill_numeric(spark, sf):
    """Fill all numeric columns (2.75 becomes 2 in integer columns)."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt", "l_quantity_opt", "p_retailprice_opt")
    return N.fill(r, 2.75)


@plan("fill_subset", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, l_quantity_opt, coalesce(p_retailprice_opt, 2.75) AS p_retailprice_opt FROM retail")
def fill_subset(spark, sf):
    """Fill named columns only."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_quantity_opt", "p_retailprice_opt")
    return N.fill(r, 2.75, ["p_retailprice_opt"])


@plan("fill_map", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, coalesce(l_partkey_opt, 'none given') AS l_partkey_opt, coalesce(p_retailprice_opt, 0.5) AS p_retailprice_opt "
      "FROM retail")
def fill_map(spark, sf):
    """Per-column fill values."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt", "p_retailprice_opt")
    return N.fill(r, {"l_partkey_opt": "none given", "p_retailprice_opt": 0.5})


@plan("fill_timestamp", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, coalesce(l_shipdate_opt, TIMESTAMP '2000-01-01 00:00:00') AS l_shipdate_opt FROM retail")
def fill_timestamp(spark, sf):
    """Impute a timestamp column."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_shipdate_opt")
    return N.fill_timestamp(r, "l_shipdate_opt", "2000-01-01 00:00:00")


@plan("replace_values", sql=_vsql(_NV, _NVV) +
      "SELECT l_orderkey, CASE WHEN l_partkey_opt = '17' THEN 'replaced' ELSE l_partkey_opt END AS l_partkey_opt FROM retail")
def replace_values(spark, sf):
    """Value -> value replacement in a column."""
    r = _variants(spark, sf, *_NV).select("l_orderkey", "l_partkey_opt")
    return N.replace_values(r, {"17": "replaced"}, ["l_partkey_opt"])


# --- key/value ---------------------------------------------------------------------

def _kv_words(spark, sf):
    return KV.key_by(words(spark, sf), KV.first_letter_lower, "word")


KV_SQL = f"(SELECT lower(substring(word, 1, 1)) AS key, word AS value FROM {WD_})"


@plan("key_by", sql=f"SELECT key, count(*) AS n FROM {KV_SQL} GROUP BY key")
def key_by(spark, sf):
    """Key derived from the value (first letter, lower case), then counted."""
    return _kv_words(spark, sf).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@plan("keys_values", sql=f"SELECT DISTINCT key FROM {KV_SQL}")
def keys_values(spark, sf):
    """The keys of a key/value table (distinct)."""
    return KV.keys(_kv_words(spark, sf)).distinct()


@plan("lookup_key", sql=f"SELECT value, count(*) AS n FROM {KV_SQL} WHERE key = 's' GROUP BY value")
def lookup_key(spark, sf):
    """Values stored under one key (then counted)."""
    return KV.lookup_key(_kv_words(spark, sf), "s").groupBy("value").agg(F.count(F.lit(1)).alias("n"))


# Spark upper-cases with Java's full case mapping (sharp s becomes SS)
JUPPER = "upper(replace(value, 'ß', 'SS'))"


@plan("map_values", sql=f"SELECT key, {JUPPER} AS value, count(*) AS n FROM {KV_SQL} GROUP BY 1, 2")
def map_values(spark, sf):
    """Transform the value, keep the key."""
    return KV.map_values(_kv_words(spark, sf), F.upper).groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))


@plan("flat_map_values", sql=f"SELECT key, value, count(*) AS n FROM (SELECT key, "
                             f"unnest(string_split({JUPPER}, '')) AS value FROM {KV_SQL}) GROUP BY 1, 2")
def flat_map_values(spark, sf):
    """Explode the value into characters, keep the key."""
    out = KV.flat_map_values(_kv_words(spark, sf), lambda v: F.split(F.upper(v), ""))
    return out.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
