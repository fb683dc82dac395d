"""Operator 10 against brute force over all pairs."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import jaccard
from quarry.llm.components import components
from quarry.llm.jaccard import Rule

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, rule):
    """[(id, n, component)] by comparing all pairs; rows with one id are one document."""
    sets = []
    for i, t in rows:
        w = words(t)
        sets.append({tuple(w[j:j + rule.words]) for j in range(len(w) - rule.words + 1)} if len(w) >= rule.words
                    else ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = rows[x][0], rows[y][0]
            if a is not None and b is not None and sets[x] and \
                    rule.den * len(sets[x] & sets[y]) >= rule.num * len(sets[x] | sets[y]):
                a, b = find(a), find(b)
                parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), find(i) if i is not None else None) for (i, _), s in zip(rows, sets, strict=True)), key=str)


def run(spark, rows, rule):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_components(df, rule=rule).collect()), key=str)


def edited(rng, base, share):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in base.split(" "))


@pytest.mark.parametrize("rule", [jaccard.Rule(4, 85, 100), jaccard.Rule(5, 80, 100), jaccard.Rule(1, 85, 100)])
def test_mixed_sizes_equal_brute_force(spark, rule):
    rng = random.Random(7)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for n in (3, 6, 8, 11, 14, 20, 33, 60, 120, 400):
        for _ in range(3):
            base = " ".join(rng.choice(vocab) for _ in range(n))
            rows += [(len(rows) + j, edited(rng, base, s)) for j, s in enumerate((0, 0, .004, .01, .02, .04, .08))]
            rows += [(len(rows) + j, base + " " + " ".join(rng.choice(vocab) for _ in range(m))) for j, m in enumerate((1, 1 + n // 8, n // 6))]
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows += [(len(rows) + j, passage + " " + " ".join(rng.choice(vocab) for _ in range(20))) for j in range(25)]
    rng.shuffle(rows)
    assert run(spark, rows, rule) == brute(rows, rule)


def test_odd_rows(spark):
    rows = [(1, "a b c d e f"), (2, "A  b\tc d\ne f"), (3, None), (4, ""), (5, "  "), (6, "one"), (7, "ONE"), (8, "one two"),
            (None, "a b c d e f"), (9, "z y x w v u"), (9, "one"), (10, "Z y x w v u"), (11, "é b c d"), (12, "É b c d"), (1, "a b c d e f")]
    rule = jaccard.Rule(4, 85, 100)
    assert run(spark, rows, rule) == brute(rows, rule)


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, rep long, n int, key int, fp1 int")
    assert jaccard.near_components(df).count() == 0
    df = spark.createDataFrame([(1, "x", 5, 6, 7, 8)], "doc_id long, text string, rep long, n int, key int, fp1 int")
    assert [tuple(r) for r in jaccard.near_components(df).collect()] == [(1, 1, 1, 1)]


def test_query_equals_brute_force(spark, sf, documents):
    got = sorted((tuple(r) for r in jaccard.op10_ngram_jaccard(spark, sf).collect()), key=str)
    assert got == brute([(d[0], d[1]) for d in documents], jaccard.Rule(4, 85, 100))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components_are_the_smallest_reachable(spark, links):
    parent = list(range(26))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for ab in links for x in ab if len(set(ab)) > 1} | {x: v for x, v in got.items() if v == find(x)}


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 400).selectExpr("id AS u", "id - 1 AS v")
    assert components(links).where("component = 0").count() == 400


@pytest.mark.parametrize("rule", [Rule(5, 80, 100), Rule(4, 85, 100), Rule(1, 50, 100)])
def test_linked_sets_have_a_part_in_common(rule):
    rng = np.random.default_rng(4)
    for _ in range(1500):
        n = int(rng.integers(1, 120))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        cut, more = rng.integers(0, n // 3 + 1), rng.integers(0, n // 3 + 1)
        a, b = np.unique(a), np.unique(np.concatenate([a[cut:], rng.integers(0, 1 << 63, more).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if len(b) and rule.den * common >= rule.num * (len(a) + len(b) - common):
            at_a, at_b = ({level: rest for level, *rest in jaccard._parts(x, rule)} for x in (a, b))
            level = min(max(at_a), max(at_b))                       # where the two meet
            (fa, ea), (fb, eb) = at_a[level], at_b[level]
            assert len(np.intersect1d(fa, fb)) + len(np.intersect1d(ea, eb)), (len(a), len(b), common)


def test_levels_hold_all_partners():
    for rule in (Rule(5, 80, 100), Rule(4, 85, 100), Rule(1, 50, 100)):
        for n in range(1, 400):
            for m in range(n, rule.den * n // rule.num + 1):
                low, high = dict(jaccard.levels(rule, n)), dict(jaccard.levels(rule, m))
                common = max(k for k in low if k in high)
                least = -(-rule.num * (n + m) // (rule.num + rule.den))      # overlap of a link
                assert n + m - 2 * least < low[common] == high[common]


def test_own_level_in_columns(spark):
    rule = Rule(4, 85, 100)
    got = spark.range(1, 3000).select("id", jaccard._own_level(rule, "id").alias("own")).collect()
    assert all(r.own == jaccard.levels(rule, r.id)[0][0] for r in got)


@pytest.mark.parametrize("short", [0, 6, 32, 1000])
def test_texts_around_one_passage(spark, monkeypatch, short):
    """Many texts that share only a passage, near copies among them: components equal those of all pairs, by parts or by lists."""
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    rng = random.Random(8)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = []
    for i in range(250):
        own = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 60)))
        for k in range(rng.choice((1, 1, 1, 3))):
            rows.append((len(rows), f"{own} {passage} tail{k % 2} {' '.join(f'x{rng.randint(0, 10**6)}' for _ in range(k))}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    rule = Rule(4, 85, 100)
    sets = {i: set(jaccard.shingles(t.encode(), 4).tolist()) for i, t in rows}
    group = {i: i for i in sets}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, j in itertools.combinations(sets, 2):
        common = len(sets[i] & sets[j])
        if 100 * common >= 85 * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((top(i), top(j)))
            group[b] = a
    assert {r.doc_id: r.component_id for r in jaccard.near_components(df, rule=rule).collect()} == {i: top(i) for i in sets}


def test_lists_with_the_same_members_are_looked_at_once(spark, monkeypatch):
    """Texts around one passage, each of its shingles a list of the same members: one list a level is left, and no pair that cannot link is met."""
    seen = {}

    def kept(df, name, *a, _stored=jaccard.stored):
        seen.setdefault(name, []).append(_stored(df, name, *a))
        return seen[name][-1]
    monkeypatch.setattr(jaccard, "stored", kept)
    passage = [f"p{i}" for i in range(60)]
    own = [[f"w{i}_{k}" for k in range(200)] for i in range(6)]
    rows = [(i, " ".join([*passage, *part])) for i, part in enumerate(own)]
    rows += [(10 + 10 * i + k, " ".join(part)) for i, part in enumerate(own) for k in range(10)]      # so the passage's shingles are the rarest
    rule = Rule(4, 85, 100)
    assert run(spark, rows, rule) == brute(rows, rule)
    assert 0 < seen["meeting"][0].count() <= 3 * len(own)
    assert seen["candidates"][1].count() == 0


def test_folded_bitmaps_keep_their_parities(spark):
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (3, 300, 1024, 1025, 5000)]
    bits = [jaccard._parity(s) for s in sets]
    df = spark.createDataFrame([(k, b.tolist()) for k, b in enumerate(bits)], "k int, bits array<bigint>")
    for r in df.select("k", jaccard._at_most("bits", 16).alias("got")).collect():
        whole = bits[r.k]
        assert r.got == (np.bitwise_xor.reduce(whole.reshape(-1, 16), axis=0) if len(whole) > 16 else whole).tolist()
