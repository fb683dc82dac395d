"""Operator 8 against a brute-force version and on held-out labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import ngrams, resampling

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=3000, seed=3):
    rng, rows, labels = random.Random(seed), [], []
    vocab = [f"word{i}" for i in range(300)]
    for i in range(n):
        kind = rng.choices(("good", "toxic", "junk", "caps", "again"), (80, 8, 5, 4, 3))[0]
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 80))]
        if kind == "toxic":
            words[::6] = [rng.choice(("moron", "moronic", "scum")) for _ in words[::6]]
        elif kind == "junk":
            words = [w + rng.choice(("%%%", "###", "$$$")) for w in words]
        elif kind == "caps":
            words = [w.upper() for w in words]
        elif kind == "again":
            words = [words[0]] * 20
        rows.append((i, " ".join(words), kind))
        if i % 2:
            labels.append((i, int(kind in ("good", "toxic")), int(kind == "toxic")))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    got = {r.kind: r.share for r in resampling.resample(df, lab).where("doc_id % 2 = 0").groupBy("kind").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert got["good"] > 0.97 and max(got[k] for k in ("toxic", "junk", "caps", "again")) < 0.05, got


def test_weights_and_draw_equal_brute_force(spark):
    rows, labels = corpus(800)
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    hold = {r.label_id for r in ngrams.label_sample(lab, 10**6).where("holdout").collect()}
    good = {i for i, q, t in labels if q == 1 and t == 0}
    raw, target = np.zeros(ngrams.BUCKETS, dtype=np.int64), np.zeros(ngrams.BUCKETS, dtype=np.int64)
    found = {i: ngrams.features(t.encode())[0] for i, t, _ in rows}
    for i, f in found.items():
        raw[f] += 1
        target[f] += i in good and i not in hold
    w, base = resampling.fit_weights(raw, target, len(rows), len(good - hold))
    expect = {i: (base + int(w[f].sum())) / resampling.SCALE for i, f in found.items()}
    out = resampling.resample(df, lab)
    assert {r.doc_id: r.log_weight for r in out.collect()} == expect
    least = np.quantile([expect[i] for i in good & hold], resampling.MISS)
    k = sum(x >= least for x in expect.values())
    keys = {r.doc_id: r.k for r in df.select("doc_id", resampling.gumbel(F.col("doc_id"), F.col("text")).alias("k")).collect()}
    order = sorted(expect, key=lambda i: -(expect[i] / resampling.TEMPERATURE + keys[i]))
    assert {r.doc_id for r in out.where("kept").collect()} == set(order[:k])


@pytest.mark.parametrize("seed", range(3))
def test_kth_largest(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice((rng.gauss(0, 1), 5.0, rng.gauss(0, 1) * 1e6)) for _ in range(9000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").cache()
    for k in (1, 2, 17, 3000, 4500, 8999, 9000, 20_000):
        assert resampling.kth_largest(df, "v", k) == sorted(values, reverse=True)[min(k, 9000) - 1]
    assert resampling.kth_largest(df.where("v > 1e300"), "v", 3) is None


def test_gumbel_noise_is_standard(spark):
    m, s = spark.range(20_000).agg(F.avg(resampling.gumbel(F.col("id"))), F.stddev(resampling.gumbel(F.col("id")))).first()
    assert abs(m - 0.5772) < 0.05 and abs(s - 1.2825) < 0.05


def test_odd_rows_and_tables(spark):
    schema = "doc_id long, text string, label_id int, quality string, holdout int, kept string, draw_key int"
    lab = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)], LABELS)
    rest = (7, "q", 8, "k", 9)
    rows = [(1, "a b", *rest), (1, "a b", *rest), (2, None, *rest), (3, "", *rest), (4, " \n", *rest), (None, "c", *rest),
            (5, "x" * 300_000, *rest)]
    got = resampling.resample(spark.createDataFrame(rows, schema), lab)
    assert got.columns == ["doc_id", "text", "label_id", "quality", "holdout", "kept", "draw_key", "log_weight", "_kept"]
    assert {r.kept for r in got.collect()} == {"k"}
    assert sorted((str(r.doc_id), r["_kept"], r.log_weight, r.draw_key) for r in got.collect()) == sorted(
        [("1", True, 0.0, 9)] * 2 + [("2", False, None, 9), ("3", False, None, 9), ("4", False, None, 9), ("None", True, 0.0, 9),
                                     ("5", True, 0.0, 9)])
    assert resampling.resample(spark.createDataFrame([], schema), lab).count() == 0
    assert resampling.resample(spark.createDataFrame(rows, schema), spark.createDataFrame([], LABELS)).where("_kept").count() == 4
    other_case = resampling.resample(spark.createDataFrame([(1, "a", 2.0)], "doc_id long, text string, LOG_WEIGHT double"), lab)
    assert other_case.columns == ["doc_id", "text", "LOG_WEIGHT", "_log_weight", "kept"] and other_case.first().LOG_WEIGHT == 2.0


def test_query_covers_all_documents(spark, sf, documents):
    got = resampling.op8_quality_resampling(spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in documents)


def ordered_corpus(n=3000, seed=5):
    """Good and bad texts of the same words: only their order tells."""
    rng, rows, labels = random.Random(seed), [], []
    vocab = [f"word{i}" for i in range(300)]
    for i in range(n):
        words, bad = [rng.choice(vocab) for _ in range(40)], i % 5 == 0
        phrases = (["put", "the", "lights", "out"], ["end", "of", "it", "all"])
        for at, phrase in zip((3, 20), phrases, strict=True):
            words[at:at + 4] = phrase[::-1] if bad else phrase
        rows.append((i, " ".join(words), "bad" if bad else "good"))
        if i % 3:
            labels.append((i, int(not bad), 0))
    return rows, labels


def test_word_order_tells(spark):
    rows, labels = ordered_corpus()
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, kind string"), spark.createDataFrame(labels, LABELS)
    got = {r.kind: r.share for r in resampling.resample(df, lab).where("doc_id % 3 = 0").groupBy("kind").agg(
        F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert got["good"] > 0.97 and got["bad"] < 0.05, got


def test_features_are_tokens_and_all_adjacent_pairs():
    def pairs(text):
        found = ngrams.features(text.encode())[0]
        return set(found[found >= ngrams.TOKENS].tolist())

    def expected(*tokens):
        hashes = [ngrams._hash(t) for t in tokens]
        return {ngrams.pair_bucket(a, b) for a, b in zip(hashes, hashes[1:], strict=False)}

    assert pairs("Stop it,  now\nstop") == expected("stop", "it", ",", "now", "stop")
    assert pairs("a \u3000 b\u00a0c (d)") == expected("a", "b", "c", "(", "d", ")")
    assert pairs("a b") != pairs("b a") and pairs("one") == pairs("") == set()
    for text, same in (("a b a b a b", "a b a"), ("w w w w", "w w")):      # the same tokens and pairs, said again or not
        assert len(ngrams.features(text.encode())[0]) > len(ngrams.features(same.encode())[0]), text
    for k in range(3):                                     # whatever stands in the cache
        ngrams._tokens.clear()
        again = [ngrams.features(t.encode())[0].tolist() for t in ("x y z", "y x", "z")[k:]]
        assert again == [ngrams.features(t.encode())[0].tolist() for t in ("x y z", "y x", "z")[k:]]


def test_features_of_words_seen_before(monkeypatch):
    """Words are cut into tokens once; features are those of the tokens of the whole text, whatever white space and signs."""
    text = "Stop; it's SIMPLE\u00a0enough,caf\u00e9\u3000stra\u00dfe \x1cx_y\x85\u0130stanbul \U0001f600\U0001f600 (ABCdefg)"
    for t in (text, "one"):
        tokens = ngrams._piece.findall(t)
        low = [x.lower() for x in tokens]
        hashes = [ngrams._hash(x) for x in low]
        expected = {h >> ngrams.SHIFT for h in hashes} | {ngrams.pair_bucket(a, b) for a, b in zip(hashes, hashes[1:], strict=False)}
        expected |= {ngrams.bucket("\x00" + x[:ngrams.STEM]) for x in low if len(x) > ngrams.STEM}
        expected |= {ngrams.CAPITALS} if any(len(x) > 1 and x.isupper() for x in tokens) else set()
        assert ngrams.features(t.encode())[0].tolist() == sorted(expected)
    first = ngrams.features(text.encode())[0].tolist()
    monkeypatch.setattr(ngrams._Words, "_cut", lambda self: pytest.fail("a known word is cut again"))
    assert ngrams.features(f"{text} one".encode())[1] == len(text.encode().split()) + 1
    assert ngrams.features(text.encode())[0].tolist() == first
    broken = b"ab\xff c\xc3"
    monkeypatch.undo()
    assert ngrams.features(broken)[0].tolist() == ngrams.features(broken.decode("utf-8", "replace").encode())[0].tolist()
