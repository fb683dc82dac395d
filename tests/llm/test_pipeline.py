"""The pipeline stage by stage, each against a brute-force version on its own input."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline as P
from quarry.llm import bpe, duckbpe, jaccard, lines, mixing, ngrams, resampling
from quarry.llm.common import stored, table
from tests.llm.test_jaccard import brute as near_brute
from tests.llm.test_lines import brute as lines_brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The documents and what every stage returns for them, over 1,000 documents."""
    sf = "/root/testdata/sf0.01"
    out = [table(spark, sf, "documents")]
    for name, f in P.STAGES:
        out.append(stored(f(spark, out[-1], sf), name))
    return [x.toPandas() for x in out]


def test_stages_are_four_or_five_and_keep_the_columns(steps):
    assert 4 <= len(P.STAGES) <= 5
    assert all(list(x.columns) == COLUMNS for x in steps[:-1])
    assert all(0 < len(x) for x in steps)


def test_quality_equals_brute_force(spark, steps):
    docs, kept = steps[0], steps[1]
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    sample = {r.label_id: r for r in ngrams.label_sample(labels, 10**6).collect()}
    target = {i: r.quality == 1 and r.toxic == 0 for i, r in sample.items()}
    found = {i: ngrams.features(t.encode())[0] for i, t in zip(docs.doc_id, docs.text, strict=True)}
    raw, tgt = np.zeros(ngrams.BUCKETS, dtype=np.int64), np.zeros(ngrams.BUCKETS, dtype=np.int64)
    for i, f in found.items():
        raw[f] += 1
        tgt[f] += target.get(i, False) and not sample[i].holdout
    w, base = resampling.fit_weights(raw, tgt, len(docs), sum(t and not sample[i].holdout for i, t in target.items()))
    weight = {i: (base + int(w[f].sum())) / resampling.SCALE for i, f in found.items()}
    least = np.quantile([weight[i] for i, t in target.items() if t and sample[i].holdout], resampling.MISS)
    k = sum(x >= least for x in weight.values())
    noise = {r.doc_id: r.g for r in table(spark, "/root/testdata/sf0.01", "documents").select(
        "doc_id", resampling.gumbel("doc_id", "text").alias("g")).collect()}
    order = sorted(weight, key=lambda i: -(weight[i] / resampling.TEMPERATURE + noise[i]))
    assert set(kept.doc_id) == set(order[:k])
    good = [i for i, t in target.items() if t]
    assert np.mean([i in set(kept.doc_id) for i in good]) > 0.98


def test_lines_equal_brute_force(steps):
    before, after = steps[1], steps[2]
    expect = {i: t for i, t, n in lines_brute(list(zip(before.doc_id, before.text, before.source, strict=True)))
              if n == 0 or t.split()}
    assert dict(zip(after.doc_id, after.text, strict=True)) == expect
    assert (after.n_chars == after.text.str.len()).all()


def test_near_duplicates_equal_brute_force(steps):
    before, after = steps[2].head(0), steps[3]
    before = steps[2]
    component = {i: c for i, _, c in near_brute(list(zip(before.doc_id, before.text, strict=True)), jaccard.Rule(5, 80, 100))}
    assert sorted(after.doc_id) == sorted(i for i, c in component.items() if i == c)
    assert len(after) < len(before)


def test_mixing_keeps_plain_documents(spark, steps):
    before, after = steps[3], steps[4]
    assert set(after.doc_id) <= set(before.doc_id)
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in table(spark, "/root/testdata/sf0.01", "labels").collect()}
    good = [i for i in before.doc_id if labels.get(i)]
    assert np.mean([i in set(after.doc_id) for i in good]) > 0.97
    assert after.doc_id.duplicated().mean() < 0.02


def test_encode_equals_the_library(steps):
    before, after = steps[4], steps[5]
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=duckbpe.read_ranks(public_tokenizers.path(bpe.MULTI_50K)))
    text = dict(zip(before.doc_id, before.text, strict=True))
    assert sorted(after.doc_id) == sorted(before.doc_id)
    for r in after.itertuples():
        assert list(r.ids) == tik.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_removed int, copy int, rate double, ids int"


def test_every_stage_takes_odd_rows_and_empty_tables(spark, sf):
    rest = ("k", 1, 2, 0.5, 3)
    rows = [(1, "a b c d e f g", "en", "s", 13, *rest), (1, "a b c d e f g", "en", "s", 13, *rest), (1, "other text", "en", "s", 10, *rest),
            (None, "a b c d e f g", None, None, None, *rest), (2, None, "en", "s", None, *rest), (3, "", None, "s", 0, *rest), (4, " \n ", "en", None, 3, *rest),
            (5, "x" * 100_000, "en", "s", 100_000, *rest), (6, "word " * 60_000, "en", "s", 300_000, *rest), (7, "a b c d e f g", "en", "t", 13, *rest)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, ODD_SCHEMA)
        counts = []
        for name, f in P.STAGES:
            out = f(spark, docs, sf)
            if name != P.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            counts.append(out.count())
        if data:
            assert counts[1:3] == [10, 7] and counts[4] == 10
        else:
            assert counts == [0] * 5


def test_registered(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run


def test_batches_of_long_texts_are_bounded(spark):
    """A stage bounds the bytes that go to a Python worker at once, unless the session has its own bound, and what is cut off a batch does not hold it."""
    from quarry.llm import common
    own = spark.conf.get(common.BATCH_SETTING, None)
    try:
        spark.conf.unset(common.BATCH_SETTING)
        long = spark.range(0, 6000, 1, 1).selectExpr("id AS doc_id", "repeat('word ', 1000) AS text")

        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})
        common.bound_batches(spark)
        found = [r.n for r in long.mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 30_000_000 and max(found) < 2 * common.BATCH_BYTES
        spark.conf.set(common.BATCH_SETTING, "1000000")
        common.bound_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING) == "1000000"
    finally:
        spark.conf.unset(common.BATCH_SETTING) if own is None else spark.conf.set(common.BATCH_SETTING, own)
    batch = pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 1000})
    parts = [*common.by_volume(iter([batch]), "text", 10_000)]
    assert len(parts) == 100 and all(p.column(0).get_total_buffer_size() < 50_000 for p in parts)
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))


def test_workers_hold_little_at_once(spark):
    """Counts leave a worker in small batches; a batch to a worker, what one query decodes and what caches keep are bounded, and the ids do not depend on it."""
    from quarry.llm import common
    counts = np.arange(3 * ngrams.BUCKETS, dtype=np.int32)
    batches = [*ngrams.count_rows(counts)]
    assert max(b.nbytes for b in batches) < 2 << 20
    rows = pa.Table.from_batches(batches).to_pydict()
    assert rows["part"] == [*range(len(counts) // ngrams.PART)] and np.array_equal(np.concatenate(rows["counts"]), counts)
    assert common.BATCH_BYTES <= 1 << 20 and bpe.IDS_PER_QUERY <= 1 << 17 and max(bpe.CACHED_WORDS, ngrams.CACHED_WORDS) <= 150_000


def test_ids_are_the_same_when_the_cache_is_full(monkeypatch):
    path = public_tokenizers.path(bpe.MULTI_50K)
    texts = ["the same words", "other words here", "the same words again", None, "", "last words"] * 3
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})

    def ids():
        return pa.Table.from_batches(bpe._encode_batches(iter([batch]), "text", "ids", path, public_tokenizers.PATTERN))["ids"].to_pylist()
    whole = ids()
    monkeypatch.setattr(bpe, "_seen", {})
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    monkeypatch.setattr(bpe, "TEXT_PER_QUERY", 20)
    monkeypatch.setattr(bpe, "WORDS_PER_QUERY", 2)
    assert ids() == whole and len(next(iter(bpe._seen.values()))) < 10
