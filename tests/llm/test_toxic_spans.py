"""Operator 13: its field against enumeration, its spans on planted words, its score on held-out rows."""

import itertools
import random
import zlib

import numpy as np
import pytest

from quarry.llm import toxic_spans

LABELS = "doc_id long, quality int, toxic int"


def paths(evidence, others):
    """Every tagging of one text with its weight."""
    bias, start, no_yes, yes_no, yes_yes = others
    link = {(0, 0): 0.0, (0, 1): no_yes, (1, 0): yes_no, (1, 1): yes_yes}
    for tags in itertools.product((0, 1), repeat=len(evidence)):
        total = start * tags[0] + sum((x + bias) * y for x, y in zip(evidence, tags, strict=True))
        yield tags, np.exp(total + sum(link[p] for p in itertools.pairwise(tags)))


def brute(texts, others):
    chance, seen = [], np.zeros((2, 2))
    for x in texts:
        found = list(paths(x, others))
        total = sum(w for _, w in found)
        chance += [sum(w for t, w in found if t[i]) / total for i in range(len(x))]
        for t, w in found:
            for a, b in itertools.pairwise(t):
                seen[a, b] += w / total
    return np.array(chance), seen


@pytest.mark.parametrize("seed", range(6))
def test_marginals_equal_enumeration(seed):
    rng = np.random.default_rng(seed)
    texts = [rng.normal(0, 2, rng.integers(1, 9)) for _ in range(rng.integers(1, 9))]
    others = rng.normal(0, 1.5, 5)
    starts = np.concatenate([np.arange(len(x)) == 0 for x in texts])
    got, seen = toxic_spans.marginals(np.concatenate(texts), starts, others, pairs=True)
    expect, pairs = brute(texts, others)
    assert np.allclose(got, expect, atol=1e-12) and np.allclose(seen, pairs, atol=1e-10)


def test_marginals_of_extreme_and_no_evidence():
    got, _ = toxic_spans.marginals(np.array([1e9, -1e9, 0.0] * 5000), np.arange(15000) == 0, np.array([-3.0, 0, -1, -1, 1]))
    assert np.isfinite(got).all() and got[0] > 0.99 and got[1] < 0.01
    assert len(toxic_spans.marginals(np.empty(0), np.empty(0, dtype=bool), np.zeros(5))[0]) == 0


def test_gradient_is_that_of_the_likelihood():
    import pyarrow as pa
    weights = np.array([0.5, -1.0, 0.8, -0.4, 0.2, -0.7, 0.3, 0.9])
    rows = [{"n": 5, "at": [0, 2, 2, 4], "feature": [0, 1, 2, 0], "gold": [2, 4]}, {"n": 3, "at": [1], "feature": [2], "gold": []},
            {"n": 1, "at": [], "feature": [], "gold": [0]}]
    schema = pa.schema([("n", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("at", "feature", "gold"))])

    def likelihood(w):
        total = 0.0
        for r in rows:
            x = np.zeros(r["n"])
            for at, f in zip(r["at"], r["feature"], strict=True):
                x[at] += w[f]
            found = dict(paths(x, w[3:]))
            total += np.log(found[tuple(int(i in r["gold"]) for i in range(r["n"]))] / sum(found.values()))
        return total
    (batch,) = toxic_spans._gradient(iter([pa.RecordBatch.from_pylist(rows, schema=schema)]), weights)
    for k in range(len(weights)):
        up = np.eye(len(weights))[k] * 1e-5
        assert abs(batch.column(0)[0].as_py()[k] - (likelihood(weights + up) - likelihood(weights - up)) / 2e-5) < 1e-6



def corpus(n=900, seed=2):
    """Toxic texts have inflected forms of a few stems, some of them only in held-out texts, or an insult of two words."""
    rng, vocab, rows, labels = random.Random(seed), [f"{a}{b}{c}" for a in "bcdfg" for b in ("anor", "elit", "irum") for c in ("a", "en", "ista")], [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 60))]
        planted = []
        if i % 6 == 0:
            for _ in range(rng.randint(2, 4)):
                bad = rng.choice(("Grobi" + rng.choice(("an", "ano", "ol", "x", "ität")), "vile scumbag"))
                planted.append(bad)
                words.insert(rng.randint(0, len(words)), bad)
        rows.append((i, " ".join(words), planted))
        if i % 4:
            labels.append((i, 1, int(i % 6 == 0)))
    copied = "all words of this one insulting text are copied many times over grobian".split()
    rows += [(n + i, " ".join([*copied, "end"]), None) for i in range(60)]
    labels += [(n + i, 1, 1) for i in range(60)]
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = corpus()
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    out = {r.doc_id: r for r in toxic_spans.score(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert len(out) == len(rows)
    unseen = [(i, t, p) for i, t, p in rows if p is not None and (zlib.crc32(str(i).encode()) % 5 == 0 or i % 4 == 0)]
    assert sum(out[i].predicted == int(bool(p)) for i, _, p in unseen) > 0.99 * len(unseen)
    for i, text, planted in unseen:
        words = [w for s in out[i].spans for w in text[s.start:s.end].split()]
        if planted:
            assert sorted(words) == sorted(w for p in planted for w in p.split())
        assert all(0.5 <= s.score <= 1 for s in out[i].spans) and 0 <= out[i].score <= 1
        assert out[i].predicted == int(out[i].score >= 0.5)
    # words that are only in copies of one toxic text are not learnt
    clean = spark.createDataFrame([(1, "all words of this one text are copied many times over")], "doc_id long, text string")
    assert toxic_spans.score(df.union(clean), spark.createDataFrame(labels, LABELS)).where("doc_id = 1 AND predicted = 1").count() == 0


def test_held_out_labels_are_not_learnt(spark):
    rows, labels = corpus(400)
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    held = {r.doc_id for r in df.where(toxic_spans.held_out("doc_id")).collect()}
    assert held == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    turned = [(i, q, 1 - t if i in held else t) for i, q, t in labels]
    a, b = (sorted(map(tuple, toxic_spans.score(df, spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect())) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    rows, labels = corpus(300)
    labels += [(None, 1, 1), (1, 1, None), (10**6, 0, 1), *labels[:5]]
    long = "banora " * 30000 + "grobian " * 3
    odd = [(None, long), (5000, None), (5001, ""), (5002, "12 34 !?"), (1, long), (1, long), (5003, "İGROBIAN̈ ß Grobianista")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t, *_ in rows] + [(i, t, "y", 2) for i, t in odd],
                               "doc_id long, text string, SCORE string, Spans int")
    out = toxic_spans.score(df, spark.createDataFrame(labels, LABELS))
    assert out.columns == ["doc_id", "text", "SCORE", "Spans", "_score", "predicted", "_spans"]
    got = out.where("SCORE = 'y'").collect()
    assert len(got) == len(odd) and len({r._score for r in got if not r.text or r.doc_id == 5002}) == 1
    for r in got:
        if r.text == long:
            assert r.predicted == 1 and [long[s.start:s.end] for s in r._spans] == ["grobian grobian grobian"]
    assert all(r.predicted == 0 for r in got if not r.text)


@pytest.mark.parametrize("toxic", [0, 1, None])
def test_without_two_classes(spark, toxic):
    df = spark.createDataFrame([(i, f"text number {i} of words like {i % 3}") for i in range(20)], "doc_id long, text string")
    out = toxic_spans.score(df, spark.createDataFrame([(i, 1, toxic) for i in range(20)], LABELS)).collect()
    assert {r.predicted for r in out} == {toxic or 0} and all(r.spans == [] for r in out)
    assert toxic_spans.score(df.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_least_rows_of_a_seed(spark):
    train = spark.createDataFrame([("rareword here", True)] * 2 + [("bad stuff", True)] * 30 + [("good stuff", False)] * 60, "text string, toxic boolean")
    chosen = toxic_spans.choose_features(train, 92, 32)
    assert chosen["=bad"] and not chosen["=good"] and "=rareword" not in chosen and "=stuff" not in chosen
