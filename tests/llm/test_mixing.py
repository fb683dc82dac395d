"""Operator 5 against a brute-force solver, held-out labels and the targets."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import mixing
from tests.llm.test_resampling import LABELS, corpus, ordered_corpus


def brute_rates(tokens, p, goal, rounds=4000):
    """Projected gradient with a small step, from 1, in numpy."""
    r, gram = np.ones(len(tokens)), (tokens[:, None] * p).T @ p
    inverse = np.linalg.pinv(gram)
    for _ in range(rounds):
        r = np.maximum(0, r - 0.05 * p @ (inverse @ ((r * tokens) @ p - goal)))
    return r


def test_posteriors_on_held_out_labels(spark):
    rows, labels = corpus()
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    out = mixing.mix(df, lab).where("doc_id % 2 = 0").groupBy("kind").agg(F.avg("p_plain"), F.avg("p_junk"), F.avg("p_toxic")).collect()
    p = {r.kind: tuple(r)[1:] for r in out}
    assert p["good"][0] > 0.97 and p["toxic"][2] > 0.9 and min(p["junk"][1], p["caps"][1], p["again"][1]) > 0.9, p


@pytest.mark.parametrize("targets", [mixing.TARGETS, {"plain": 0.5, "junk": 0.3, "toxic": 0.2}, {"plain": 1, "junk": 0, "toxic": 0}])
def test_rates_match_the_targets(spark, targets):
    rows, labels = corpus()
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    out = mixing.mix(df, lab, targets).collect()
    tokens = np.array([r.n_tokens for r in out], dtype=float)
    p = np.array([[r.p_plain, r.p_junk, r.p_toxic] for r in out])
    rate, copies = np.array([r.rate for r in out]), np.array([r.n_copies for r in out])
    assert [r.n_tokens for r in out] == [len(r.text.split()) for r in out] and (rate >= 0).all()
    weights = np.array([targets[d] for d in mixing.DOMAINS], dtype=float)
    goal = weights / weights.sum() * (tokens @ p[:, 0]) / (weights[0] / weights.sum())
    # good text is never wholly plain, so a target of no junk at all stays out of reach
    slack = 2e-3 if targets["junk"] else 2e-2
    assert np.abs((rate * tokens) @ p - goal).max() < slack * tokens.sum()
    slow = brute_rates(tokens, p, goal)
    inverse = np.linalg.pinv((tokens[:, None] * p).T @ p)
    loss = [e @ inverse @ e for e in ((x * tokens) @ p - goal for x in (rate, slow))]
    assert loss[0] < loss[1] * 1.02 + 1e-3
    assert np.abs(copies - rate).max() < 1
    assert np.abs((copies * tokens) @ p - goal).max() < 0.03 * tokens.sum()
    good = [r.n_copies >= 1 for r in out if r.kind == "good"]
    assert np.mean(good) > 0.97


def test_posteriors_equal_brute_force(spark):
    rows, labels = corpus(500)
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    domain = {i: 2 if t else 1 - q for i, q, t in labels}
    counts, n = np.zeros((3, mixing.ngrams.BUCKETS), dtype=np.int64), np.zeros(3)
    found = {i: mixing.ngrams.features(t.encode())[0] for i, t, _ in rows}
    for i, d in domain.items():
        counts[d, found[i]] += 1
        n[d] += 1
    base, w = mixing.fit_posteriors(counts, n)
    for r in mixing.mix(df, lab).collect():
        s = np.exp(base + w[:, found[r.doc_id]].sum(axis=1))
        assert (r.p_plain, r.p_junk, r.p_toxic) == pytest.approx(tuple(s / s.sum()), abs=1e-9)


def test_odd_rows_and_tables(spark):
    schema = "doc_id long, text string, rate string, label_id int, domain int, luck int"
    lab = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1)], LABELS)
    rows = [(1, "a b", "r", 1, 2, 3), (1, "a b", "r", 1, 2, 3), (None, "c", "r", 1, 2, 3), (2, None, "r", 1, 2, 3), (3, "", "r", 1, 2, 3),
            (4, "y " * 200_000, "r", 1, 2, 3)]
    for labels in (lab, spark.createDataFrame([], LABELS)):
        out = mixing.mix(spark.createDataFrame(rows, schema), labels)
        assert out.columns[:6] == ["doc_id", "text", "rate", "label_id", "domain", "luck"]
        got = out.collect()
        assert sorted(r.n_tokens for r in got) == [0, 0, 1, 2, 2, 200_000]
        assert all(r.rate == "r" and r.luck == 3 for r in got)
        assert all(r._rate >= 0 and r.p_plain + r.p_junk + r.p_toxic == pytest.approx(1) for r in got)
    assert mixing.mix(spark.createDataFrame([], schema), lab).count() == 0


def test_query_covers_all_documents(spark, sf, documents):
    got = {r.doc_id: r.n_tokens for r in mixing.op5_mixing(spark, sf).collect()}
    assert got == {d[0]: len((d[1] or "").encode().split()) for d in documents}


def test_word_order_tells(spark):
    rows, labels = ordered_corpus()
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    p = {r.kind: r.p for r in mixing.mix(df, lab).where("doc_id % 3 = 0").groupBy("kind").agg(F.avg("p_plain").alias("p")).collect()}
    assert p["good"] > 0.75 and p["bad"] < 0.05, p          # four fifths of the labels are plain; a missing pair says nothing


def test_features_of_many_texts_are_those_of_each():
    """Texts cut together have the features that each has by definition; nothing runs over from a text to the next."""
    import pyarrow as pa

    from quarry.llm import ngrams
    texts = [None, b"", b" \t ", b"a b", b"b a b a b a", "İSTANBUL ΑΣ'Α ΣΑΣ, ok\x1cb c_d  A".encode(), b"\xff\xfe w w w w", b"w w", b"x, longer-words! X AND MORE", b"\x1c \x1d"]

    def plain(text):
        found, pairs = set(), []
        tokens = [t for w in (text or b"").split() for t in ngrams.re.findall(r"\w+|[^\w\s]+", w.decode("utf-8", "replace"))]
        low = [t.lower() for t in tokens]
        hashes = [ngrams._hash(t) for t in low]
        pairs = [(ngrams.ODD * a + b) & (1 << 64) - 1 for a, b in zip(hashes, hashes[1:], strict=False)]
        found |= {h >> ngrams.SHIFT for h in hashes} | {ngrams.pair_bucket(a, b) for a, b in zip(hashes, hashes[1:], strict=False)}
        found |= {ngrams.bucket("\x00" + t[:ngrams.STEM]) for t in low if len(t) > ngrams.STEM}
        found |= {ngrams.CAPITALS for t in tokens if len(t) > 1 and t.isupper()}
        nearer = set()
        for k in ngrams.ECHOES:
            again = {i for i in range(k, len(pairs)) if pairs[i] == pairs[i - k]} - nearer
            nearer |= again
            found |= {int(ngrams.ECHO[k][len(again).bit_length()])} if again else set()
        return sorted(found)
    ngrams._tokens.clear()
    for many in (texts, texts[::-1], texts * 3):
        found, bounds, n = ngrams.features_of(pa.array(many, pa.binary()))
        assert n.tolist() == [len((t or b"").split()) for t in many]
        assert [found[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)] == [plain(t) for t in many]
    assert ngrams.sums(np.array([1, 2, 3]), np.array([0, 0, 2, 2, 3, 3])).tolist() == [0, 3, 0, 3, 0]
