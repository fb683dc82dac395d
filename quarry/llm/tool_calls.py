"""Operator 9: tool-call linking for chat data. DataFrame functions only.

Calls and results meet in a hash join by (conversation, call id). Rows equal in every column are one row with their number (``times``);
every other call and result is a row of its own, however many share an id. What the rows of an id have in common (how many calls and
results it has, its earliest call, its first answer) is aggregated to one row an id, and that row is joined to them; rows are
salted by a hash of their content, and facts go only to the (id, salt) pairs that exist, so an id with very many rows is shared out over
``SALTS`` join keys and nothing is multiplied. Calls are ordered topologically by their depth below the call they refer to (a reference
means the earliest call of an id: least position, then name, then parent), found by pointer jumping: every round a call learns its
ancestor twice as far away, so a chain of n calls takes log2(n) joins. Arguments are parsed as variants, validated against the tool's
schema, and written as canonical JSON: keys sorted at every depth, no blanks, numbers in one form.

Each round is written to the shared folder; no round, group or conversation is gathered in one place.

Edge cases: a call without id is a row of its own and links with nothing; a null conversation is a conversation; arguments that
are null, no JSON object, have a key twice or exceed the variant limit are ``malformed``; a call of an unknown tool is ``unknown tool``; a
parent that does not exist makes a root; calls on or below a cycle have no level (``cyclic``); a result without call or id is
an ``orphan``; turns that are neither call nor result keep a row (``other role``), null roles included; empty tables give no rows; other
columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table

SCHEMAS = "name string, params array<struct<name:string,type:string,required:boolean,max_length:int>>"

#: Join keys that the rows of one id, or the calls of one parent, are shared out over.
SALTS = 256


def _json_type(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return (F.when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
            .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
            .when((kind == "BIGINT") | kind.rlike(r"^DECIMAL\(\d+,0\)$"), "integer").otherwise("number"))


def argument_errors(arguments: str, params: str) -> Column:
    """Sorted errors of the variant column ``arguments`` under the schema column ``params``; null where it is no object."""
    fields = F.try_variant_get(F.col(arguments), "$", "map<string,variant>")

    def check(p):
        value = F.try_element_at(fields, p["name"])
        said = F.array_contains(F.map_keys(fields), p["name"])
        kind = _json_type(value)
        fits = (kind == p["type"]) | ((p["type"] == "number") & (kind == "integer"))
        return (F.when(~said, F.when(p["required"], F.concat(F.lit("missing:"), p["name"])))
                .when(~fits, F.concat(F.lit("type:"), p["name"]))
                .when((kind == "string") & (F.length(F.try_variant_get(value, "$", "string")) > p["max_length"]),
                      F.concat(F.lit("length:"), p["name"])))

    known = F.transform(params, lambda p: p["name"])
    unknown = F.transform(F.array_except(F.map_keys(fields), known), lambda k: F.concat(F.lit("unknown:"), k))
    return F.array_sort(F.concat(F.filter(F.transform(params, check), lambda e: e.isNotNull()), unknown))


def levels(calls: DataFrame) -> DataFrame:
    """(conv, id, level): how many calls lie above each of the calls (conv, id, parent); null on or below a cycle.

    (conv, id) must be unique.
    """
    def same(a, b, left, right):
        return F.col(f"{a}.conv").eqNullSafe(F.col(f"{b}.conv")) & (F.col(f"{a}.{left}") == F.col(f"{b}.{right}"))

    own = calls.select("conv", "id", "parent").alias("s")
    state = stored(own.join(calls.select("conv", "id").alias("t"), same("s", "t", "parent", "id"), "left")
                   .select("s.conv", "s.id", F.col("t.id").alias("up"), F.when(F.col("t.id").isNotNull(), 1).otherwise(0).alias("level")), "levels")
    total, open_ = state.agg(F.count(F.lit(1)), F.count("up")).first()
    reach = 1
    while open_ and reach <= total:
        state = stored(state.alias("s").join(state.alias("t"), same("s", "t", "up", "id"), "left")
                       .select("s.conv", "s.id", F.col("t.up").alias("up"),
                               (F.col("s.level").cast("long") + F.coalesce("t.level", F.lit(0))).alias("level")), "levels")
        reach *= 2
        open_ = state.agg(F.count("up")).first()[0]
    return state.select("conv", "id", F.when(F.col("up").isNull(), F.col("level")).cast("long").alias("level"))


def _with_facts(rows: DataFrame, key: str, facts: DataFrame) -> DataFrame:
    """``rows`` with the row of ``facts`` (one a conversation and id) that their column ``key`` names, or nulls; ``rows`` has a ``salt``.

    The facts first meet the distinct (conv, key, salt), at most ``SALTS`` a key, and then the rows by all three.
    """
    wanted = rows.where(F.col(key).isNotNull()).select("conv", key, "salt").distinct()
    spread = wanted.alias("w").join(facts.alias("f"), F.col("w.conv").eqNullSafe(F.col("f.conv")) & (F.col(f"w.{key}") == F.col("f.id"))).select(
        "w.*", *[F.col(f"f.{c}") for c in facts.columns if c not in ("conv", "id")])
    return rows.alias("r").join(
        spread.alias("s"), F.col("r.conv").eqNullSafe(F.col("s.conv")) & (F.col(f"r.{key}") == F.col(f"s.{key}")) & (F.col("r.salt") == F.col("s.salt")),
        "left").select("r.*", *[F.col(f"s.{c}") for c in facts.columns if c not in ("conv", "id")])


def _messages(calls: DataFrame, results: DataFrame, others: DataFrame | None) -> DataFrame:
    """Calls, results and other turns as one table, equal rows once with their number, and a salt from their content."""
    none = F.lit(None).cast("string")
    rows = calls.select(F.lit("call").alias("kind"), "conv", "id", "parent", "position", "name", "arguments", none.alias("content")).unionByName(
        results.select(F.lit("result").alias("kind"), "conv", "id", none.alias("parent"), "position", none.alias("name"), none.alias("arguments"), "content"))
    if others is not None:
        rows = rows.unionByName(others.select(F.lit("other").alias("kind"), "conv", none.alias("id"), none.alias("parent"), "position",
                                              "name", none.alias("arguments"), "content"))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times")).withColumn(
        "salt", F.pmod(F.xxhash64("position", "name", "arguments", "content"), F.lit(SALTS)))


def link_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One row per different call, per different result and per other turn.

    ``calls``: conv, id, parent, position, name, arguments (JSON text); ``results``: conv, id, position, content; ``schemas``: SCHEMAS, a row per tool;
    ``others``: conv, position, name, content. Returned: kind (call, result, other), conv, id, name (a result's: that of its id's earliest call), level (a
    result's: that of the same call), position, times (equal rows), n_calls and n_results (of the id, equal ones included; 0 without id), answered_at (position
    of the id's first result), status (call: answered, unanswered, cyclic, no id; result: result, orphan; other: other role), errors, call_json (canonical).
    The topological order of a conversation is (level, position, id), a call before its results.
    """
    rows = stored(_messages(calls, results, others), "messages")
    is_call = F.col("kind") == "call"
    facts = stored(rows.where(F.col("id").isNotNull()).groupBy("conv", "id").agg(
        F.sum(F.when(is_call, F.col("times")).otherwise(0)).alias("n_calls"), F.sum(F.when(is_call, 0).otherwise(F.col("times"))).alias("n_results"),
        F.min(F.when(is_call, F.struct("position", "name", "parent"))).alias("first_call"),
        F.min(F.when(~is_call, F.col("position"))).alias("answered_at")), "ids")
    at = levels(facts.where("first_call IS NOT NULL").select("conv", "id", "first_call.parent"))
    facts = stored(facts.alias("f").join(at.alias("a"), F.col("f.conv").eqNullSafe(F.col("a.conv")) & (F.col("f.id") == F.col("a.id")), "left").select(
        "f.conv", "f.id", "n_calls", "n_results", "answered_at", F.col("first_call.name").alias("call_name"), F.col("level").alias("call_level")), "facts")
    above = facts.where("n_calls > 0").select("conv", "id", F.lit(True).alias("has_parent"), F.col("call_level").alias("parent_level"))
    linked = _with_facts(_with_facts(rows, "id", facts), "parent", above)
    has_id = F.col("id").isNotNull()
    linked = linked.withColumns({
        "n_calls": F.coalesce("n_calls", F.lit(0)).cast("long"), "n_results": F.coalesce("n_results", F.lit(0)).cast("long"),
        "level": F.when(is_call & has_id, F.when(F.col("has_parent"), F.col("parent_level") + 1).otherwise(0)).when(~is_call, F.col("call_level")).cast("long"),
        "name": F.when(F.col("kind") == "result", F.col("call_name")).otherwise(F.col("name")), "parsed": F.try_parse_json("arguments")})
    status = (F.when(F.col("kind") == "other", "other role")
              .when(is_call, F.when(~has_id, "no id").when(F.col("level").isNull(), "cyclic").when(F.col("n_results") > 0, "answered").otherwise("unanswered"))
              .when(F.col("n_calls") > 0, "result").otherwise("orphan"))
    tools = schemas.groupBy(F.col("name").alias("tool")).agg(F.first("params").alias("params"))   # one row per name
    checked = linked.join(tools, is_call & (F.col("name") == F.col("tool")), "left")
    errors = argument_errors("parsed", "params")
    canonical = F.to_json(F.struct(F.col("parsed").alias("arguments"), F.col("id"), F.col("level"), F.col("name"), F.col("content").alias("result")),
                          {"ignoreNullFields": "false"})
    return checked.select(
        "kind", "conv", "id", "name", "level", "position", "times", "n_calls", "n_results", "answered_at", status.alias("status"),
        F.when(~is_call, F.array().cast("array<string>")).when(F.col("tool").isNull(), F.array(F.lit("unknown tool")))
        .otherwise(F.coalesce(errors, F.array(F.lit("malformed")))).alias("errors"), canonical.alias("call_json"))


ASK_LIMIT = 400


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Chat turns as calls, results and others: a user or system turn calls a tool with its text, and the turn after a user's
    answers it. A call refers to the call two turns earlier, the first user turn to the system turn. Turns of other or null roles are the
    others, named by their role. A null turn gives a null id, a null text a null ``body``."""
    at, text = F.col("turn"), F.expr("substring(to_json(struct(text AS body), map('ignoreNullFields', 'false')), 2)")       # "body":"..."}
    calls = turns.where("role IN ('user', 'system')").select(
        F.col("conv_id").alias("conv"), F.concat(F.lit("call-"), at).alias("id"),
        F.concat(F.lit("call-"), F.when(at >= 2, at - 2).when(at == 1, 0)).alias("parent"), at.alias("position"),
        F.when(F.col("role") == "user", "ask").otherwise("configure").alias("name"),
        F.concat(F.lit('{ "turn" : '), F.coalesce(at.cast("string"), F.lit("null")), F.lit(" , "), text).alias("arguments"))
    results = turns.where("role = 'assistant'").select(
        F.col("conv_id").alias("conv"), F.concat(F.lit("call-"), at - 1).alias("id"), at.alias("position"), F.col("text").alias("content"))
    others = turns.where("role IS NULL OR role NOT IN ('user', 'system', 'assistant')").select(
        F.col("conv_id").alias("conv"), at.alias("position"), F.col("role").alias("name"), F.col("text").alias("content"))
    return calls, results, others


OP9_SQL = f"""
WITH RECURSIVE messages AS (
    SELECT CASE WHEN role IN ('user', 'system') THEN 'call' WHEN role = 'assistant' THEN 'result' ELSE 'other' END AS kind, conv_id AS conv,
           CASE WHEN role IN ('user', 'system') THEN turn WHEN role = 'assistant' THEN turn - 1 END AS key, turn AS position,
           CASE role WHEN 'user' THEN 'ask' WHEN 'system' THEN 'configure' WHEN 'assistant' THEN NULL ELSE role END AS said, text, count(*) AS times
    FROM conversations GROUP BY conv_id, turn, role, text
), ids AS (
    SELECT conv, key, sum(CASE kind WHEN 'call' THEN times ELSE 0 END) AS n_calls, sum(CASE kind WHEN 'call' THEN 0 ELSE times END) AS n_results,
           min(said) AS call_name, min(CASE kind WHEN 'result' THEN position END) AS answered_at,
           CASE WHEN key >= 2 THEN key - 2 WHEN key = 1 THEN 0 END AS up
    FROM messages WHERE key IS NOT NULL GROUP BY conv, key
), called AS (
    SELECT * FROM ids WHERE n_calls > 0
), depth AS (
    SELECT c.conv, c.key, 0 AS level FROM called c
    WHERE NOT EXISTS (SELECT 1 FROM called p WHERE p.conv IS NOT DISTINCT FROM c.conv AND p.key = c.up)
    UNION ALL
    SELECT c.conv, c.key, d.level + 1 FROM depth d JOIN called c ON c.conv IS NOT DISTINCT FROM d.conv AND c.up = d.key
), linked AS (
    SELECT m.*, coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results, answered_at, level,
           CASE kind WHEN 'result' THEN call_name ELSE said END AS name
    FROM messages m LEFT JOIN ids i ON i.conv IS NOT DISTINCT FROM m.conv AND i.key = m.key
    LEFT JOIN depth d ON d.conv IS NOT DISTINCT FROM m.conv AND d.key = m.key
)
SELECT kind, conv, 'call-' || key AS id, name, level, position, times, n_calls, n_results, answered_at,
       CASE WHEN kind = 'other' THEN 'other role' WHEN kind = 'result' THEN CASE WHEN n_calls > 0 THEN 'result' ELSE 'orphan' END
            WHEN key IS NULL THEN 'no id' WHEN level IS NULL THEN 'cyclic' WHEN n_results > 0 THEN 'answered' ELSE 'unanswered' END AS status,
       CASE WHEN kind <> 'call' THEN '' ELSE array_to_string([e FOR e IN [
                CASE WHEN name = 'ask' AND length(text) > {ASK_LIMIT} THEN 'length:body' END,
                CASE WHEN text IS NULL THEN 'type:body' END, CASE WHEN position IS NULL THEN 'type:turn' END] IF e IS NOT NULL], ',') END AS errors,
       sha256('{{"arguments":' || CASE kind WHEN 'call' THEN '{{"body":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"turn":'
              || coalesce(position::VARCHAR, 'null') || '}}' ELSE 'null' END
              || ',"id":' || coalesce('"call-' || key || '"', 'null') || ',"level":' || coalesce(level::VARCHAR, 'null')
              || ',"name":' || coalesce(to_json(name)::VARCHAR, 'null')
              || ',"result":' || CASE kind WHEN 'call' THEN 'null' ELSE coalesce(to_json(text)::VARCHAR, 'null') END || '}}') AS call_sha256
FROM linked
"""


@query("op9_tool_calls", OP9_SQL)
def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of all conversations as a linked, ordered, validated call, as a result or as another turn, its canonical JSON as a hash."""
    calls, results, others = conversation_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(
        [("ask", [("body", "string", True, ASK_LIMIT), ("turn", "integer", True, None)]),
         ("configure", [("body", "string", True, None), ("turn", "integer", False, None)])], SCHEMAS)
    return link_calls(calls, results, schemas, others).select(
        "kind", "conv", "id", "name", "level", "position", "times", "n_calls", "n_results", "answered_at", "status",
        F.array_join("errors", ",").alias("errors"), F.sha2("call_json", 256).alias("call_sha256"))
