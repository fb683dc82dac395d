"""Operator 9 against its SQL and against brute force in Python."""

import json
import random

import pytest

from quarry.llm import tool_calls as T
from tools.oracle_check import digest

CALLS = "conv long, id string, parent string, position long, name string, arguments string, level int, params int"
RESULTS = "conv long, id string, position long, content string, tool int"
TOOLS = [("f", [("a", "integer", True, None), ("s", "string", False, 3), ("o", "object", False, None), ("n", "number", False, None)]), ("g", [])]


def run(spark, calls, results, tools=TOOLS):
    out = T.link_calls(spark.createDataFrame([(*c, 1, 2) for c in calls], CALLS),
                       spark.createDataFrame([(*r, 3) for r in results], RESULTS), spark.createDataFrame(tools, T.SCHEMAS))
    return out.collect()


@pytest.mark.parametrize("arguments,errors", [
    ('{"a":1}', []), ('{"a":1.0,"n":2,"s":"abc"}', []), ('{"a":1.5}', ["type:a"]), ('{}', ["missing:a"]), ('{"a":null}', ["type:a"]),
    ('{"a":1,"s":"abcd","z":0}', ["length:s", "unknown:z"]), ('{"a":1,"o":[]}', ["type:o"]), ('{"a":1,"o":{"z":{}}}', []),
    ('{"a":"1","n":true}', ["type:a", "type:n"]), ("[1]", ["malformed"]), ("{", ["malformed"]), (None, ["malformed"]), ("", ["malformed"]),
    ('{"a":1,"a":2}', ["malformed"]), ('{"a":12345678901234567890}', [])])
def test_arguments_against_a_schema(spark, arguments, errors):
    (row,) = run(spark, [(1, "x", None, 0, "f", arguments)], [])
    assert (row.status, row.errors) == ("unanswered", errors)


def test_canonical_json(spark):
    row, answer = sorted(run(spark, [(1, "x", None, 0, "f", '{ "s" : "\\u00e9\\n" , "a":1.00,\n"o":{"z":[{"k":1,"b":2}],"B":1e2}}')], [(1, "x", 1, 'a "b"')]), key=lambda r: r.kind)
    assert row.call_json == '{"arguments":{"a":1,"o":{"B":100.0,"z":[{"b":2,"k":1}]},"s":"é\\n"},"id":"x","level":0,"name":"f","result":null}'
    assert json.loads(row.call_json)["arguments"]["o"] == {"B": 100, "z": [{"k": 1, "b": 2}]}
    assert answer.call_json == '{"arguments":null,"id":"x","level":0,"name":"f","result":"a \\"b\\""}'


def test_links_levels_and_odd_rows(spark):
    calls = [(1, "a", None, 0, "f", "{}"), (1, "b", "a", 1, "g", "{}"), (1, "c", "b", 2, "h", "{}"), (1, "d", "nowhere", 3, "g", None),
             (1, "p", "q", 4, "g", "{}"), (1, "q", "p", 5, "g", "{}"), (1, "r", "q", 6, "g", "{}"), (1, "self", "self", 7, "g", "{}"),
             (2, "a", "b", 0, "g", "{}"), (None, "a", None, 0, "g", "{}"), (None, "b", "a", 0, None, "{}"), (1, None, "a", 9, "g", "{}"), (1, None, "a", 9, "g", "{}")]
    results = [(1, "a", 1, "ra"), (1, "a", 0, "first"), (1, "zz", 3, "lost"), (None, "a", 4, None), (2, None, 5, "x"), (1, "q", 8, "rq")]
    out = run(spark, calls, results)
    got = sorted(((str(r.conv), str(r.id), r.kind, r.level, r.status, r.times, r.n_calls, r.n_results, r.answered_at) for r in out), key=str)
    assert got == sorted([
        ("1", "a", "call", 0, "answered", 1, 1, 2, 0), ("1", "a", "result", 0, "result", 1, 1, 2, 0), ("1", "a", "result", 0, "result", 1, 1, 2, 0),
        ("1", "b", "call", 1, "unanswered", 1, 1, 0, None), ("1", "c", "call", 2, "unanswered", 1, 1, 0, None),
        ("1", "d", "call", 0, "unanswered", 1, 1, 0, None), ("1", "p", "call", None, "cyclic", 1, 1, 0, None),
        ("1", "q", "call", None, "cyclic", 1, 1, 1, 8), ("1", "q", "result", None, "result", 1, 1, 1, 8), ("1", "r", "call", None, "cyclic", 1, 1, 0, None),
        ("1", "self", "call", None, "cyclic", 1, 1, 0, None), ("2", "a", "call", 0, "unanswered", 1, 1, 0, None),
        ("None", "a", "call", 0, "answered", 1, 1, 1, 4), ("None", "a", "result", 0, "result", 1, 1, 1, 4),
        ("None", "b", "call", 1, "unanswered", 1, 1, 0, None), ("1", "None", "call", None, "no id", 2, 0, 0, None),
        ("1", "zz", "result", None, "orphan", 1, 0, 1, 3), ("2", "None", "result", None, "orphan", 1, 0, 0, None)], key=str)
    assert sorted(str(json.loads(r.call_json)["result"]) for r in out if r.kind == "result") == sorted(["ra", "first", "lost", "None", "x", "rq"])
    assert {r.id: r.errors for r in run(spark, calls, []) if r.conv == 1 and r.id in ("c", "d")} == {"c": ["unknown tool"], "d": ["malformed"]}


def test_every_different_call_and_result_of_an_id_is_kept(spark):
    calls = [(3, "root", None, 0, "g", "{}"), (3, "many", None, 5, "g", '{"x":1}'), (3, "many", "root", 4, "g", "{}"),
             (3, "many", None, 5, "g", '{"x":1}'), (3, "many", "many", 6, "f", '{"a":1}'), (3, "below", "many", 7, "g", "{}")]
    results = [(3, "many", 8, "one"), (3, "many", 8, "two"), (3, "many", 9, "one"), (3, "many", 8, "one")]
    out = run(spark, calls, results)
    said = {(r.position, r.name, r.level, r.times, tuple(r.errors)) for r in out if r.kind == "call" and r.id == "many"}
    assert said == {(4, "g", 1, 1, ()), (5, "g", 0, 2, ("unknown:x",)), (6, "f", 2, 1, ())}
    given = {(r.position, json.loads(r.call_json)["result"], r.name, r.level, r.times) for r in out if r.kind == "result"}
    assert given == {(8, "one", "g", 1, 2), (8, "two", "g", 1, 1), (9, "one", "g", 1, 1)}
    assert {(r.n_calls, r.n_results, r.answered_at) for r in out if r.id == "many"} == {(4, 4, 8)}
    assert [(r.level, r.status) for r in out if r.id == "below"] == [(2, "unanswered")]


def test_an_id_with_most_rows_is_shared_out(spark):
    from pyspark.sql import functions as F
    calls = [(1, "hot", "up", i % 3, "g", json.dumps({"k": i})) for i in range(3000)] + [(1, "up", None, 0, "g", "{}")]
    results = [(1, "hot", 9, f"r{i}") for i in range(2000)]
    out = run(spark, calls, results)
    assert len(out) == 5001 and {(r.n_calls, r.n_results, r.level) for r in out if r.id == "hot"} == {(3000, 2000, 1)}
    rows = T._messages(spark.createDataFrame([(*c, 1, 2) for c in calls], CALLS), spark.createDataFrame([(*r, 3) for r in results], RESULTS), None)
    assert rows.groupBy("conv", "id", "salt").count().agg(F.max("count")).first()[0] < 60


def test_turns_of_every_role_equal_sql(spark, tmp_path):
    import duckdb
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, 0, 1, 2, 3, 4]), rng.choice(["user", "user", "system", "assistant", "tool", None]),
             rng.choice([None, "", "a \"b\"", "é\n", "x" * 401])) for _ in range(250)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    rel, df = con.sql(T.OP9_SQL), T.op9_tool_calls(spark, str(tmp_path))
    out = df.collect()
    assert digest(df.columns, [tuple(r) for r in out]) == digest(rel.columns, rel.fetchall())
    assert sum(r.times for r in out) == len(rows)
    assert {"other role", "no id", "orphan", "answered", "result"} <= {r.status for r in out}


def test_levels_equal_brute_force(spark):
    rng, rows = random.Random(4), []
    for conv in range(5):
        for i in range(60):
            rows.append((conv, f"c{i}", None if rng.random() < 0.1 else f"c{rng.randrange(70)}"))
    rows += [(9, f"c{i}", f"c{i - 1}") for i in range(300)]
    parent = {(c, i): p for c, i, p in rows}

    def depth(key):
        seen, n = set(), 0
        while (key[0], parent[key]) in parent:
            if key in seen:
                return None
            seen.add(key)
            key, n = (key[0], parent[key]), n + 1
        return n
    got = {(r.conv, r.id): r.level for r in T.levels(spark.createDataFrame(rows, "conv long, id string, parent string")).collect()}
    assert got == {k: depth(k) for k in parent}


def test_empty_tables(spark):
    assert run(spark, [], [], []) == []


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    rel, df = con.sql(T.OP9_SQL), T.op9_tool_calls(spark, sf_dir)
    s, d = digest(df.columns, [tuple(r) for r in df.collect()]), digest(rel.columns, rel.fetchall())
    assert s[:3] == d[:3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
