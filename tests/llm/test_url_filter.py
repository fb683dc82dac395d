"""Operator 7 against its SQL and brute force; the cascade against the list itself."""

import random

import numpy as np
import pytest

from quarry.llm import url_filter as U
from tools.oracle_check import digest


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:end]


def brute(rows, listed):
    def fits(host, path, h, p):
        return (host == h or host.endswith("." + h)) and path.startswith(p)
    out = []
    for i, url in rows:
        host, path = split(url)
        rules = [(len(h + p), len(h), h + p, v) for h, p, v in listed if v != "blocked" and fits(host, path, h, p)]
        blocked = any(v == "blocked" and fits(host, path, h, p) for h, p, v in listed)
        best = max(rules, default=None)
        out.append((i, host, path, best and best[2], best[3] if best else ("block" if blocked else "allow")))
    return sorted(out, key=str)


def run(spark, rows, listed):
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS path", "3 AS id", "4 AS candidates")
    lst = spark.createDataFrame(listed, "host string, path string, list string")
    return sorted((tuple(r) for r in U.judge(df, lst).collect()), key=str)


ODD = ["http://a.example.net/en/x", "http://EXAMPLE.Net/EN/x", "http://example.net", "http://net/", "http://xnet/", "http://x.net/",
       "https://a.org/fr/", "https://a.org/fr", "https://a.org/fr/?x#y", "ftp://b.example.com/de/1?q=/fr/", "http://É.net/en/", None, "", "no scheme/net/",
       "http://", "http:///net/", "http://?x", "a://b://c.net/z", "http://x.net:80/", "http://u@x.net/", "http://x.net./", "http://..net/a",
       "http://x.net?/en/", "http://spam.example.org/de/", "http://x-spam.q/", "http://spam.q", "http://a.bets.q/\n/b", "http://" + "a." * 3000 + "net/" + "y/" * 5000]


def test_odd_urls(spark):
    listed = [*U.RULES, ("spam.q", "", "blocked"), ("x-spam.q", "", "blocked"), ("bets.q", "/\n", "blocked"), ("example.org", "/de", "blocked")]
    rows = list(enumerate(ODD)) + [(0, ODD[0]), (None, ODD[5])]
    assert run(spark, rows, listed) == brute(rows, listed)


def test_empty_list_and_empty_table(spark):
    rows = list(enumerate(ODD))
    assert run(spark, rows, []) == brute(rows, [])
    assert run(spark, [], U.RULES) == []


@pytest.mark.parametrize("limits", [(50, 10**6), (50, 100)])
def test_many_keys_in_segments_and_groups(spark, monkeypatch, limits):
    monkeypatch.setattr(U, "SEGMENT_KEYS", limits[0])
    monkeypatch.setattr(U, "BROADCAST_BYTES", limits[1])
    rng = random.Random(1)
    hosts = [f"{rng.choice('abc')}{i}.{rng.choice(['q', 'r', 's.t'])}" for i in range(60)]
    rows = [(i, f"http://{rng.choice(['', 'm.', 'x.y.'])}{rng.choice(hosts)}/{rng.randrange(9)}/{rng.randrange(9)}") for i in range(400)]
    listed = [(rng.choice(hosts), rng.choice(["", "/1", "/2/", "/3/4"]), rng.choice(["allow", "block", "blocked"])) for _ in range(60)]
    listed = list({(h, p): (h, p, v) for h, p, v in listed}.values())
    assert run(spark, rows, listed) == brute(rows, listed)


@pytest.mark.parametrize("n,share", [(20_000, 0.01), (20_000, 0.5), (5_000, 0.99), (300, 1.0), (300, 0.0)])
def test_cascade_is_exact_over_its_universe(n, share):
    rng = np.random.default_rng(n)
    hashes = U._hashes([(f"h{i}", "/") for i in range(n)])
    listed = rng.random(n) < share
    levels = U.build_cascade(hashes, listed)
    assert np.array_equal(U.member(levels, hashes), listed)
    if share == 0.01:
        assert sum(x.size for x in levels) < 20 * listed.sum()      # bits, against 128 for the hashes themselves


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_sql(spark, sf_dir):
    import duckdb
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    rel, df = con.sql(U._sql()), U.op7_url_filter(spark, sf_dir)
    s, d = digest(df.columns, [tuple(r) for r in df.collect()]), digest(rel.columns, rel.fetchall())
    assert s[:3] == d[:3]
    assert df.where("rule IS NULL AND verdict = 'block'").count() > 0
