"""Operator 11 against a brute-force version, and its bounds."""

import random
import re
from collections import Counter

import pytest

from quarry.llm import phrases


def brute(rows, top=2000, least=30):
    counts = {}
    for lang, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for k in range(1, 5):
                counts.setdefault("und" if lang is None else lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = sum(c for p, c in f.items() if len(p) == 1), []
        many = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        for p, a in many.items():
            score, k = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not any(5 * c >= 4 * a and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in many.items()):
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, le, r, n, -s) for i, (s, a, p, le, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def corpus(n=700, seed=5):
    """Texts with fixed phrases of two to six words among words of very different frequency."""
    rng, rows = random.Random(seed), []
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    fixed = ["New York City", "red Herring", "a b c d e f", "x the y", "Q. R s t", "ö ß", "once upon a time there"]
    for i in range(n):
        text = rng.choices(words, weights, k=rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            text.insert(rng.randint(0, len(text)), rng.choice(fixed))
        for _ in range(rng.randint(0, 4)):
            text.insert(rng.randint(0, len(text)), rng.choice((",", "\n", "; ", "\x0c", "\x1f", "tab\tword")))
        rows.append((rng.choice(("en", "en", "en", "de", None, "und")), " ".join(text)))
    return rows + [("en", None), ("fr", ""), (None, " \t,"), ("en", "New York City " * 40)]


@pytest.mark.parametrize("top", [2000, 15, 3])
@pytest.mark.parametrize("steps", [phrases.STEPS, (900_000, 700_000, 100_000, 0), (0,)])
def test_equals_brute_force(spark, top, steps):
    rows = corpus()
    df = spark.createDataFrame([(1, a, b, "x") for a, b in rows], "N int, lang string, text string, f string").repartition(3)
    out = phrases.mine(df, top=top, steps=steps)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == brute(rows, top)


def test_full_tables_of_bounds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "WORD_BITS", 4)
    monkeypatch.setattr(phrases, "PAIR_BITS", 5)
    rows = corpus()
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.mine(df, top=10).collect())) == brute(rows, 10)


def test_empty(spark):
    assert phrases.mine(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.mine(spark.createDataFrame([("en", "a b"), (None, None)], "lang string, text string")).count() == 0


def test_scores_of_counts_beyond_64_bits(spark):
    a = 4_000_000_000_000_000_000
    pair = spark.createDataFrame([("en", 2, "x y", a)], "lang string, size int, phrase string, f long")
    words = spark.createDataFrame([("en", "x", a), ("en", "y", a + 10**18)], "lang string, phrase string, f long")
    assert phrases.score_phrases(pair, words).first().score == 2_000_000 * a // (2 * a + 10**18)


def test_blocks_end_with_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "TEXT_PER_BLOCK", 8)
    text = b"a b c d e f g h i. j k, l m n o p q r s t u v w; x"
    blocks = list(phrases.token_blocks([text, b"y z"]))
    assert len(blocks) > 2 and [t for b in blocks for t in b] == text.replace(b".", b" \xff ").replace(b",", b" \xff ").replace(b";", b" \xff ").split() + [b"\xff", b"y", b"z"]
    assert all(b[-1] == b"\xff" for b in blocks[:-1])


def test_blocks_of_numbered_words(monkeypatch):
    """A block knows its own words by number, each once, and keeps none for the next; words held across blocks are merged."""
    import pyarrow as pa
    (data,) = phrases._blocks([b" The cat.\tthe CAT", b"", b"\x1f!"])
    block = phrases.Block("en", data)
    words, counts = block.counts()
    assert dict(zip(words.to_pylist(), counts.tolist(), strict=True)) == {"the": 2, "cat": 2, "\x1f": 1}
    assert [k == 0 for k in block.ids] == [False, False, True, False, False, True, True, False, True]
    assert block.hashes().tolist()[:2] == [phrases.word_hash("en", w) for w in (b"the", b"cat")] and block.hashes()[2] == 0
    assert phrases.Block("en", b" \xff ").counts()[0].to_pylist() == []
    monkeypatch.setattr(phrases, "HELD", 3)
    monkeypatch.setattr(phrases, "TEXT_PER_BLOCK", 8)
    texts = ["a b. c", "a a", "d e f g h. i", "a"]
    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y", "x", "x"], "text": texts})
    found = Counter()
    for out in phrases._count_words(iter([batch])):
        for lang, word, f in zip(out.column(0).to_pylist(), out.column(2).to_pylist(), out.column(3).to_pylist(), strict=True):
            found[lang, word] += f
    assert found == Counter([("x", w) for w in "abcdefghia"] + [("y", "a")] * 2)
