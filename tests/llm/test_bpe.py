"""Operator 1 against the tiktoken library, and an exact round trip."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.llm import bpe, duckbpe

PATH = public_tokenizers.path(bpe.MULTI_50K)


@pytest.fixture(scope="module")
def tik():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=duckbpe.read_ranks(PATH), special_tokens={})


ODD = ["", "   ", "a", "a" * 3001, "ab" * 1500, "\n\n \t x", "naïve café 日本語 🙂🙂", "<|endoftext|>", "x" * 65 + "y" * 70,
       "don't we'll 123456 !!!???", "\x1c\x1d a\x85b\xa0c", "aaab" * 40, "é" * 200, " " * 500 + "z", "\x00\x01"]


def test_odd_texts_encode_as_the_library(spark, tik):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None), (1, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, list(r.ids)) for r in bpe.encode(df, "text", PATH).collect())
    assert got == sorted((i, tik.encode_ordinary(t or "")) for i, t in rows)
    back = bpe.decode(bpe.encode(df, "text", PATH), "ids", PATH).collect()
    assert sorted((r.doc_id, bytes(r.decoded)) for r in back) == sorted((i, (t or "").encode()) for i, t in rows)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é\n's1!日", max_size=200))
def test_words_encode_as_the_library(text):
    ref = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=duckbpe.read_ranks(PATH), special_tokens={}) \
        if not hasattr(test_words_encode_as_the_library, "ref") else test_words_encode_as_the_library.ref
    test_words_encode_as_the_library.ref = ref
    worker = duckbpe.worker(PATH)
    if text:
        short, = worker._encode([text.encode()], duckbpe.ENCODE)
        long, = worker._encode([text.encode()], duckbpe.ENCODE_LONG)
        assert short.tolist() == long.tolist() == ref._encode_single_piece(text)


def test_decode_nulls_and_partial_characters(spark):
    ids = duckbpe.worker(PATH).encode(["日".encode()[:2]])[0].tolist()
    df = spark.createDataFrame([(1, ids), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: bytes(r.decoded) for r in bpe.decode(df, "ids", PATH).collect()} == {1: "日".encode()[:2], 2: b"", 3: b""}


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, ids string, decoded int")
    out = bpe.decode(bpe.encode(empty, "text", PATH), "ids", PATH)
    assert out.columns == ["doc_id", "ids", "decoded"] and out.count() == 0
    one = spark.createDataFrame([(1, "a b", "old", 5)], "doc_id long, text string, ids string, word int")
    r = bpe.encode(one, "text", PATH).first()
    assert r.word == 5 and len(r.ids) == 2


def test_query_equals_the_library(spark, sf, documents, tik):
    got = {r.doc_id: tuple(r) for r in bpe.op1_byte_bpe(spark, sf).collect()}
    assert len(got) == len(documents)
    for doc_id, text, *_ in documents:
        ids = tik.encode_ordinary(text or "")
        assert got[doc_id] == (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                               hashlib.sha256((text or "").encode()).hexdigest())


def test_merge_rows_cover_every_split():
    ranks = {b"a": 0, b"b": 1, b"ab": 2, b"aba": 3}
    rows = {tuple(r.values())[:3] for r in duckbpe.merge_rows(ranks).to_pylist()}
    assert rows == {(0, 1, 2), (2, 0, 3)}
    assert np.all([r["safe"] for r in duckbpe.merge_rows(ranks).to_pylist()])


def test_unknown_id_raises(spark):
    df = spark.createDataFrame([(1, [50_300])], "k int, ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(df, "ids", PATH).select(F.length("decoded")).collect()


def test_very_long_words_take_no_folder(tmp_path, monkeypatch):
    """Words far beyond LONG_WORD: the library's ids, in the memory given, without a file beside the worker."""
    import random

    import public_tokenizers
    import tiktoken

    from quarry.llm import duckbpe
    monkeypatch.chdir(tmp_path)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("x", pat_str=r"(?s).+", mergeable_ranks=duckbpe.read_ranks(path), special_tokens={})
    rng = random.Random(4)
    words = ["".join(rng.choice(letters) for _ in range(n)).encode() for letters, n in (
        ("ab", 300), ("abcdefghij", 5000), ("é漢字ü", 700), ("=-_", 900), ("aeiou n", 66))] + [b"a" * 20_000, b"ha" * 3000]
    got = duckbpe.DuckBPE(path).encode(words)
    assert [list(g) for g in got] == [library._core_bpe.encode_single_piece(w) for w in words]
    assert not list(tmp_path.iterdir())


def test_another_operators_cache_releases_the_database(spark):
    """A worker that goes on to another operator holds neither the words nor DuckDB of this one."""
    from quarry.llm.common import claim
    batch = pa.RecordBatch.from_pydict({"text": ["some words", None]})
    (got,) = bpe._encode_batches(iter([batch]), "text", "ids", PATH, bpe.public_tokenizers.PATTERN)
    assert got.num_rows == 2 and duckbpe.worker.cache_info().currsize
    claim({})
    assert not duckbpe.worker.cache_info().currsize and not any(bpe._seen.values())
    (again,) = bpe._encode_batches(iter([batch]), "text", "ids", PATH, bpe.public_tokenizers.PATTERN)
    assert again.equals(got)


def test_packed_words_and_documents_without_ids():
    """Ids of many words come as bytes, without an array each; documents without ids stand between others when decoded in one sort."""
    worker = duckbpe.worker(PATH)
    words = [b"word", b"", "日本語".encode(), b"x" * 90, b" the", b"zqzqzq"]
    assert worker.packed(words) == [ids.astype("<i4").tobytes() for ids in worker.encode(words)]
    assert worker.packed([]) == []
    ids = worker.encode(words)
    doc = np.repeat(np.array([1, 2, 4, 5, 8, 9], dtype=np.int32), [len(i) for i in ids])
    assert worker.decode(np.concatenate(ids), doc, 11) == [b"", words[0], b"", b"", words[2], words[3], b"", b"", words[4], words[5], b""]
    assert worker.decode(np.empty(0, dtype=np.int32), np.empty(0, dtype=np.int32), 2) == [b"", b""]
