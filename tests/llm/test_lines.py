"""Operator 3 against a brute-force count and its SQL."""

from collections import defaultdict

import pytest

from quarry.llm import lines
from tools.oracle_check import digest

NAV = "home about contact us"


BLANKS = " \t\n\x0b\x0c\r"


def needed(line):
    return 5 if len(line) >= 40 else 10 if len(line) >= 12 else 15


def brute(rows, min_sites=None):
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for k, ln in enumerate((text or "").split("\n")):
            key = ln.strip(BLANKS)
            if key:
                if site is not None:
                    sites[key].add(site)
                first[key] = min(first.get(key, (i, k)), (i, k))
    out = []
    for i, text, site in rows:
        if text is None:
            out.append((i, None, 0))
            continue
        keep = [ln for k, ln in enumerate(text.split("\n")) if not (key := ln.strip(BLANKS))
                or len(sites[key]) < (min_sites or needed(key)) or first[key] == (i, k)]
        out.append((i, "\n".join(keep), len(text.split("\n")) - len(keep)))
    return sorted(out)


def test_spread_decides_not_frequency(spark):
    rows = [(i, f"own line number {i}\n{NAV}", f"s{i % 7}") for i in range(40)]
    rows += [(100 + i, "the same site line\nx", "s0") for i in range(50)]       # many copies, one site
    rows += [(200, None, "s1"), (201, "", "s2"), (202, f" {NAV} \nend", None), (203, f"{NAV}\n{NAV}\n{NAV}", "s3")]
    rows += [(300 + i, "on five sites only", f"s{i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for t in (5, 6, 7, 8):
        got = sorted((r.doc_id, r.text, r.n_removed) for r in lines.dedup_lines(df, min_sites=t).collect())
        assert got == brute(rows, t), t


def test_many_sites_use_the_sketch(spark):
    rows = [(i, f"wide spread line\nown text of {i}", f"s{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert lines.dedup_lines(df, min_sites=1500).where("n_removed = 1").count() == 2999
    assert lines.dedup_lines(df, min_sites=2999).where("n_removed = 1").count() == 2999
    assert lines.dedup_lines(df, min_sites=3001).where("n_removed = 1").count() == 0


def test_columns_that_clash_and_empty_table(spark):
    schema = "doc_id long, text string, source string, line int, drop int, id int, n_removed string, first int, text_hash int, own_text_hash int"
    assert lines.dedup_lines(spark.createDataFrame([], schema)).count() == 0
    one = spark.createDataFrame([(1, NAV + "\nz", "a", 7, 8, 9, "old", 6, 5, 4), (2, NAV, "b", 7, 8, 9, "old", 6, 5, 4)], schema)
    got = {r.doc_id: r for r in lines.dedup_lines(one, min_sites=2).collect()}
    assert (got[1].text, got[1].drop, got[1].n_removed) == (NAV + "\nz", 8, 0)
    assert (got[2].text, got[2].n_removed) == ("", 1)


def test_repeated_rows_null_ids_and_long_lines(spark):
    long = "w" * 200_000
    rows = [(5, NAV, "a"), (5, NAV, "a"), (None, NAV, "b"), (6, long, "a"), (7, long + " b c", "b"), (7, long + " b c", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in lines.dedup_lines(df, min_sites=2).collect())
    assert got == [(-1, 0), (5, 1), (5, 1), (6, 0), (7, 0), (7, 0)]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    df = lines.op3_line_dedup(spark, sf_dir)
    rel = con.sql(lines.OP3_SQL)
    s, d = digest(df.columns, [tuple(r) for r in df.collect()]), digest(rel.columns, rel.fetchall())
    assert s[:3] == d[:3]
    assert df.where("n_removed > 0").count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sites_by_length(spark):
    """Long lines are boilerplate on few sites, short ones on many; none is exempt."""
    rows, i = [], 0
    for line, sites in (("a long line that stands on five sites of many", 5), ("another long line that stands on four sites only", 4),
                        ("ten sites ok", 10), ("nine sites..", 9), ("Menu", 15), ("Top", 14)):
        for k in range(sites):
            rows.append((i, f"own text {i}\n {line}\t", f"s{k}"))
            i += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cut = {r.doc_id for r in lines.dedup_lines(df).where("n_removed = 1").collect()}
    first, want = 0, set()
    for n, bad in ((5, True), (4, False), (10, True), (9, False), (15, True), (14, False)):
        want |= set(range(first + 1, first + n)) if bad else set()
        first += n
    assert cut == want
