"""Operator 1: byte-level BPE encoding and decoding.

Spark partitions the documents; every task streams them through DuckDB queries
(:mod:`quarry.llm.duckbpe`). A task collects the distinct words of a bounded volume of text, encodes
those it has not met yet with one recursive query, and joins the ids up in text order. There is no
shuffle, so a hot key or large group of copies changes nothing, and a lost task is simply run again.

Edge cases: a null or empty text has no ids (an empty array) and decodes to empty bytes; null ids
decode to empty bytes; an id outside the vocabulary raises; repeated rows stay; other columns pass
through under their names, and a clashing output name replaces the column of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import duckbpe
from .common import by_volume, claim, query, table

MULTI_50K = "byte_bpe_multi_50k.tiktoken"
TEXT_PER_QUERY = 1 << 20   # bytes of text whose new words go to one DuckDB query
WORDS_PER_QUERY = 8_000
CACHED_WORDS = 150_000     # words a worker remembers; when full, only those of the text at hand stay
IDS_PER_QUERY = 1 << 17    # ids that one DuckDB query decodes


class _Known(dict):
    """Ids of words. Emptied for another operator's cache, the worker's DuckDB goes with it."""

    def clear(self) -> None:
        super().clear()
        duckbpe.worker.cache_clear()


_seen: dict[tuple[str, str], _Known] = {}


def _word_ids(words: set[str], path: str, known: dict[str, bytes]) -> None:
    """Adds the ids (little-endian int32) of words that ``known`` lacks."""
    new = [*(words - known.keys())]
    for i in range(0, len(new), WORDS_PER_QUERY):
        part = new[i:i + WORDS_PER_QUERY]
        known.update(zip(part, duckbpe.worker(path).packed([w.encode() for w in part]), strict=True))


def _encode_batches(batches: Iterator[pa.RecordBatch], text: str, out: str, path: str,
                    pattern: str) -> Iterator[pa.RecordBatch]:
    find = regex.compile(pattern).findall
    known: dict[str, bytes] = claim(_seen.setdefault((path, pattern), _Known()))
    for batch in by_volume(batches, text, TEXT_PER_QUERY):
        at = batch.schema.get_field_index(text)
        words = [find(t or "") for t in batch.column(at).to_pylist()]
        wanted = set().union(*words)
        if len(known) > CACHED_WORDS:
            stay = {w: known[w] for w in wanted & known.keys()}
            dict.clear(known)
            known.update(stay)
        _word_ids(wanted, path, known)
        ids = [b"".join(map(known.__getitem__, ws)) for ws in words]
        words = wanted = None
        offsets = np.cumsum([0] + [len(b) // 4 for b in ids], dtype=np.int32)
        column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
        keep = [i for i, f in enumerate(batch.schema) if f.name not in (text, out)]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [column],
                                         names=[batch.schema.field(i).name for i in keep] + [out])


def encode(df: DataFrame, text: str, path: str, out: str = "ids",
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``df`` with the column ``text`` replaced by ``out``, the ids of the whole text.

    ``path`` is a rank file that every executor can open. Each match of ``pattern`` is encoded on
    its own: its bytes are the first tokens, and the leftmost adjacent pair whose joined bytes have
    the smallest rank is contracted until no pair is in the file. Special tokens are plain text.
    """
    fields = [f for f in df.schema.fields if f.name not in (text, out)]
    schema = T.StructType([*fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(lambda it: _encode_batches(it, text, out, path, pattern), schema)


def _decode_batches(batches: Iterator[pa.RecordBatch], ids: str, out: str, path: str) -> Iterator[pa.RecordBatch]:
    for batch in by_volume(batches, ids, IDS_PER_QUERY):
        col = batch.column(batch.schema.get_field_index(ids))
        counts = np.array([0 if n is None else n for n in pc.list_value_length(col).to_pylist()])
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        doc = np.repeat(np.arange(batch.num_rows, dtype=np.int32), counts)
        texts = duckbpe.worker(path).decode(flat, doc, batch.num_rows)
        keep = [i for i, f in enumerate(batch.schema) if f.name != out]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(texts, pa.binary())],
                                         names=[batch.schema.field(i).name for i in keep] + [out])


def decode(df: DataFrame, ids: str, path: str, out: str = "decoded") -> DataFrame:
    """``df`` with ``out``, the bytes that the array column ``ids`` stands for.

    Bytes, not text: ids need not end at a character's end.
    """
    fields = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.BinaryType())])
    return df.mapInArrow(lambda it: _decode_batches(it, ids, out, path), schema)


def round_trip(df: DataFrame, text: str, path: str, ids: str = "ids", out: str = "decoded",
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass over the Python workers: ``text`` replaced by ``ids`` and ``out``."""
    fields = [f for f in df.schema.fields if f.name not in (text, ids, out)]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(out, T.BinaryType())])
    return df.mapInArrow(
        lambda it: _decode_batches(_encode_batches(it, text, ids, path, pattern), ids, out, path), schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Per document: number of ids, and hashes of the ids and of their decoded bytes."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document by the multilingual 50k ranks, decoded again, as digests."""
    path = public_tokenizers.path(MULTI_50K)
    return digests(round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", path))
