"""Operator 12 against a brute-force version."""

import hashlib
import math
import re
import zlib

import pytest

from quarry.llm import target_draw

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute(docs, target):
    s, t = [0] * 10000, [0] * 10000
    found = [features(text) for _, text in docs]
    for _, f in found:
        for b in f:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (n, f) in zip(docs, found, strict=True):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    drawn = [r + [k + 1] for k, r in enumerate(able[:len(able) * 5 // 100])]
    return drawn + [r + [None] for r in able[len(drawn):]] + [r + [None] for r in rows if r[1] < 20]


def key(row):
    return tuple((x is None, x or 0) for x in row)


def same(df, docs, target):
    return sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, brute(docs, target)), key=key)


COLUMNS = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


@pytest.mark.parametrize("segments", [None, 1, 7, 40])
def test_equals_brute_force(spark, documents, segments):
    docs = [(r[0], r[1]) for r in documents]
    target = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("text").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = target_draw.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), segments=segments)
    assert same(out.select(COLUMNS), docs, target)


def test_odd_rows(spark):
    long = "Éa b7 C-d " * 300
    docs = [(1, None), (2, ""), (3, "\x00\x7f [] "), (4, long), (4, long), (None, long), (None, None), (6, "x " * 20), (7, "x " * 19),
            (8, "ÀB z\x85y " * 12)] + [(100 + i, f"w{i % 7} " * 25) for i in range(60)]
    target = ["b7 c d", None, ""]
    df = spark.createDataFrame([(i, t, 9, i) for i, t in docs], "doc_id long, text string, Rank int, WEIGHT long")
    out = target_draw.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), segments=4)
    assert out.columns == ["doc_id", "Rank", "WEIGHT", "n_words", "n_features", "_weight", "score", "_rank"]
    assert same(out.select("doc_id", "n_words", "n_features", "_weight", "score", "_rank"), docs, target)
    kept = target_draw.resample(df, spark.createDataFrame([], "text string"), keep_text=True)
    assert same(kept.select("doc_id", "n_words", "n_features", "_weight", "score", "_rank"), docs, [])
    assert sorted(r.text or "" for r in kept.collect()) == sorted(t or "" for _, t in docs)
    assert target_draw.resample(df.limit(0), df.select("text")).count() == 0


def test_blocks_of_long_texts(monkeypatch):
    words = [b"w%d" % (i % 13) for i in range(50)]
    whole = sorted(x for part in target_draw.buckets(words) for x in part.tolist())
    monkeypatch.setattr(target_draw, "WORDS_PER_BLOCK", 7)
    assert sorted(x for part in target_draw.buckets(words) for x in part.tolist()) == whole
    assert [list(p) for p in target_draw.buckets([])] == []


def test_segments_are_even_and_ranks_exact_on_equal_scores(spark):
    df = spark.createDataFrame([(i, 5 if i % 3 else i) for i in range(3000)], "doc_id long, score long").repartition(6)
    out = target_draw.draw_ranked(df, "score", "doc_id", "rank", (50, 100), segments=10)
    got = sorted((r["rank"], r.doc_id) for r in out.collect() if r["rank"])
    order = sorted(range(3000), key=lambda i: (-(5 if i % 3 else i), i))
    assert got == [(k + 1, i) for k, i in enumerate(order[:1500])]
