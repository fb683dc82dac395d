"""Operator 2 against brute force over all pairs, and the recall of its filters."""

import math

import numpy as np
import pytest

from quarry.llm import spherical


def brute(rows, cosine=0.95):
    """[(id, n_links, component, kept)]; rows of one id are one node."""
    def usable(i, v):
        return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ok = [(i, np.array(v, dtype=np.float64)) for i, v in rows if usable(i, v)]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = [0] * len(ok)
    for x in range(len(ok)):
        for y in range(x):
            (i, a), (j, b) = ok[x], ok[y]
            if len(a) == len(b) and (np.array_equal(a, b) or a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine):
                links[x] += 1
                links[y] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = [(i, n, find(i), i == find(i)) for (i, _), n in zip(ok, links, strict=True)]
    out += [(i, 0, find(i) if i is not None else None, i is not None and find(i) == i) for i, v in rows if not usable(i, v)]
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep long, n int, d int")
    return sorted((tuple(r) for r in spherical.near_vectors(df).collect()), key=str)


def near(rng, v, cosine):
    t = rng.standard_normal(len(v))
    t -= (t @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine ** 2) * t / np.linalg.norm(t)


@pytest.mark.parametrize("block", [1024, 16])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(spherical, "BLOCK", block)
    rng, rows = np.random.default_rng(5), []
    for g in range(12):
        base = rng.standard_normal(64)
        for c in (1.0, 1.0, 0.999, 0.99, 0.97, 0.96, 0.955, 0.945, 0.93, 0.9):
            rows.append((len(rows), (near(rng, base, c) * rng.uniform(0.1, 9)).astype(np.float32).tolist()))
    hub = rng.standard_normal(64)
    rows += [(len(rows) + k, near(rng, hub, 0.985).astype(np.float32).tolist()) for k in range(120)]
    rows += [(len(rows) + k, hub.astype(np.float32).tolist()) for k in range(20)]
    rows += [(len(rows) + k, rng.standard_normal(64).astype(np.float32).tolist()) for k in range(150)]
    order = rng.permutation(len(rows))
    rows = [(int(order[k]), v, 0, 1, 2, 3) for k, (_, v) in enumerate(rows)]
    assert run(spark, rows) == brute([r[:2] for r in rows])


def test_odd_rows(spark):
    inf, nan, rest = float("inf"), float("nan"), (0, 1, 2, 3)
    vectors = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0], [1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 0.0], [1.0, 2.0, 0.0],
               [1e-30, 2e-30], [1e30, 2e30], [-1.0, -2.0], [5.0], [7.0], [-0.0, 1.0], [0.0, 1.0]]
    rows = [(i, v, *rest) for i, v in enumerate(vectors)]
    rows += [(None, [1.0, 2.0], *rest), (6, [1.0, 2.0], *rest), (14, [9.0, 1.0, 5.0], *rest), (30, [9.0, 1.0, 5.0], *rest)]
    assert run(spark, rows) == brute([r[:2] for r in rows])
    assert run(spark, []) == []


def test_query_equals_brute_force(spark, sf):
    import duckdb
    rows = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet'").fetchall()
    assert sorted((tuple(r) for r in spherical.op2_embedding_dedup(spark, sf).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("n", [1 << 14, 1 << 16, 1 << 21])
def test_recall_at_the_threshold(n):
    rng, code = np.random.default_rng(1), spherical.ProductCode(64, n)
    x = rng.standard_normal((600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([near(rng, v, 0.95) for v in x])
    met = [len(np.intersect1d(a, b)) > 0 for a, b in zip(code.decode(x), code.decode(y), strict=True)]
    assert np.mean(met) > 0.97


def test_decoding_finds_all_exceeding_filters():
    code, rng = spherical.ProductCode(8, 300), np.random.default_rng(2)
    x = rng.standard_normal((40, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for v, got in zip(x, code.decode(x), strict=True):
        expect = []
        for r, (rot, words) in enumerate(zip(code.rotations, code.words, strict=True)):
            for number in range(code.b ** code.m):
                digits = [number // code.b ** (code.m - 1 - j) % code.b for j in range(code.m)]
                total = sum((v @ rot)[lo:hi] @ w[k] for (lo, hi), w, k in zip(code.blocks, words, digits, strict=True))
                if total >= code.least:
                    expect.append(r * code.b ** code.m + number)
        assert sorted(got.tolist()) == expect
