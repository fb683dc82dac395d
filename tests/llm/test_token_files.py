"""Operator 4 against the tokenizers library, and the file format against plain Zstandard."""

import io
import struct
import zlib

import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import frames, token_files

PATH = public_tokenizers.path(token_files.WORD_BPE)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def expected(rows, tokenizer):
    """(id, start, n, crc) in order of id, then of the order given."""
    out, start = [], 0
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def run(spark, rows, folder):
    df = spark.createDataFrame(rows, "doc_id long, text string, shard int, frame int")
    manifest = token_files.write_shards(df, str(folder / "out"), PATH)
    bases = {r.shard: r.base for r in token_files.shard_starts(manifest).collect()}
    got = [(r.id, bases[r.shard] + r.start_in_shard, len(r.ids) // 4, zlib.crc32(bytes(r.ids)))
           for r in token_files.read_documents(manifest).collect()]
    return sorted(got, key=lambda r: r[1]), manifest


def test_odd_texts(spark, tmp_path, tokenizer):
    texts = ["Hello  World's end", None, "", " \n\t ", "<|endoftext|> and<|startoftext|>x", "é é Σας ΣΑΣ İ", "x" * 5000,
             "a b c\x1cd\x85e\x0bf\x0cg", "日本語 한국어", "don't 12345 !!!", "ﬁ Å Å", "word " * 90_000, " ́x", "­ a‍b",
             "<|ENDOFTEXT|>", "<|EndOfText|> x", "a<|STARTOFTEXT|>b", "<|endoftext|>.", "A<|endoftext|>B,", "word., Word,. WORD... ª º µ ÿ ß,", ", . ,."]
    rows = [(7 * k, t, 0, 0) for k, t in enumerate(texts)]
    got, _ = run(spark, rows[::-1], tmp_path)
    assert got == expected([r[:2] for r in rows], tokenizer)


def test_repeated_rows_null_ids_and_empty_table(spark, tmp_path, tokenizer):
    rows = [(None, "b", 0, 0), (3, "c d", 0, 0), (3, "c d", 0, 0), (3, "other", 0, 0), (1, None, 0, 0)]
    got, _ = run(spark, rows, tmp_path)
    assert [g[0] for g in got] == [None, 1, 3, 3, 3]
    assert [g[1] for g in got] == [sum(x[2] for x in got[:k]) for k in range(5)]
    assert sorted(g[2:] for g in got) == sorted(e[2:] for e in expected([r[:2] for r in rows], tokenizer))
    assert run(spark, [], tmp_path)[0] == []


def test_query_equals_the_library(spark, sf, documents, tokenizer):
    got = sorted((tuple(r) for r in token_files.op4_token_files(spark, sf).collect()), key=lambda r: r[1])
    assert got == expected([d[:2] for d in documents], tokenizer)


def test_only_wanted_frames_are_read(spark, tmp_path, tokenizer):
    rows = [(k, f"text {k} " + "word " * 30_000, 0, 0) for k in range(12)]
    _, manifest = run(spark, rows, tmp_path)
    assert manifest.count() >= 3
    for r in manifest.where("NOT array_contains(doc_ids, 5)").collect():   # damage every other frame
        reader = frames.ShardReader(r.file)
        fs, at = frames.file_system(r.file)
        data = bytearray(open(at, "rb").read())
        data[reader.offsets[r.frame] + 6] ^= 0xFF
        open(at, "wb").write(data)
    got = token_files.read_documents(manifest.where("array_contains(doc_ids, 5)")).where("id = 5").first()
    assert zlib.crc32(bytes(got.ids)) == expected([rows[5][:2]], tokenizer)[0][3]
    with pytest.raises(Exception, match="damaged|decompress|corrupt"):
        token_files.read_documents(manifest).collect()


def test_shard_is_plain_zstandard(tmp_path):
    w = frames.ShardWriter(str(tmp_path / "a" / "x.zst"))
    parts = [b"first" * 100, b"", b"third"]
    assert [w.write(p) for p in parts] == [0, 1, 2]
    w.close()
    data = (tmp_path / "a" / "x.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read() == b"".join(parts)
    r = frames.ShardReader(str(tmp_path / "a" / "x.zst"))
    assert [r.read(k) for k in (2, 0, 1)] == [b"third", b"first" * 100, b""]
    (tmp_path / "a" / "y.zst").write_bytes(data[:-1])
    with pytest.raises(ValueError):
        frames.ShardReader(str(tmp_path / "a" / "y.zst"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|StartOfText|>", *"ab c.,'\n\x1c\x85\xa0éÉßµªΣİ!9"]),
                         st.characters(max_codepoint=0x24F)), max_size=60).map("".join))
def test_texts_encode_as_the_library(text):
    whole = token_files._tokenizer(PATH).encode(text, add_special_tokens=False).ids
    assert token_files.encode_texts([text], PATH) == [struct.pack(f"<{len(whole)}I", *whole)]
