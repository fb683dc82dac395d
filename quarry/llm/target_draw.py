"""Operator 12: importance resampling towards a target table, drawn by parallel sorting by regular sampling.

A text's features are its runs of one to three words, hashed into ``BUCKETS``; a bucket's gain is the log ratio of its rates in the target
and in all documents, and a text's weight the sum of its features' gains. Both counts are over whole tables: every task gives at most one
row per bucket, so the driver gets ``BUCKETS`` numbers. Weights are then read off the array of gains in a second pass.

Score is weight plus Gumbel noise from a hash of the id. The highest scores are drawn, each with its exact rank, without a global sort in one
place: every run (a partition of the scored table) is sorted where it is and gives keys at regular steps; these samples, sorted, give the splitters; rows go
to the segment between their splitters, whose sorted pieces are merged there; the counts of the segments before give a row's rank. Samples are
bounded by ``SAMPLES`` whatever the table; with s samples of each run a segment holds at most its fair share plus one step (1/s) of every run.
Texts are not shuffled.

Edge cases: a null or empty text has no words, no features and weight 0; rows below ``least_words`` have a score and are never drawn;
a null id is hashed like an empty one and stands last among equal scores; repeated rows each count, and have ranks of their own; empty
tables give empty results, an empty target gains from the documents' counts alone; other columns pass through, the text only if asked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_volume, claim, fresh, query, stored, table

# fixed values: hashing, noise and share of the draw
BUCKETS = 10_000
SEED = "42"
LEAST_WORDS = 20
SHARE = (5, 100)

SAMPLES = 1 << 20            # keys that all runs give together, at most
TEXT_PER_BATCH = 4 << 20
WORDS_PER_BLOCK = 1 << 18    # of one text at a time

# small letters, digits and bytes beyond ASCII stay, capitals become small, the rest is blank
_plain = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def split_words(text: bytes | None) -> list[bytes]:
    """The words of a text in UTF-8."""
    return (text or b"").translate(_plain).split()


def buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """The buckets of all runs of one to three words, a block of the text at a time."""
    for at in range(0, len(words), WORDS_PER_BLOCK):
        block = words[at:at + WORDS_PER_BLOCK + 2]
        after = [b" " + w for w in block[1:]]
        one = list(map(crc32, block[:WORDS_PER_BLOCK]))
        two = list(map(crc32, after, one))               # the checksum goes on from that of the run one shorter
        yield np.array(one + two + list(map(crc32, after[1:], two)), dtype=np.int64) % BUCKETS


def _texts(batches: Iterator[pa.RecordBatch], column: str):
    for batch in by_volume(batches, column, TEXT_PER_BATCH):
        yield batch, batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim({})
    sums = np.zeros(BUCKETS, dtype=np.int64)
    for _, texts in _texts(batches, "text"):
        for text in texts:
            for found in buckets(split_words(text)):
                sums += np.bincount(found, minlength=BUCKETS)
    seen = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(sums[seen])], names=["bucket", "n"])


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How often the features of all texts fall into each bucket."""
    rows = (df.select(F.col(text).alias("text")).mapInArrow(_count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows:
        counts[r.bucket] = r.n
    return counts


def gains(target: np.ndarray, every: np.ndarray) -> np.ndarray:
    """A feature's gain by bucket, in thousandths, rounded down."""
    up, down = float(every.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * up / ((s + 1.0) * down)))
                     for t, s in zip(target.tolist(), every.tolist(), strict=True)], dtype=np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], text: str, gain, names: list[str], keep_text: bool) -> Iterator[pa.RecordBatch]:
    claim({})
    by_bucket = gain.value
    for batch, texts in _texts(batches, text):
        out = np.zeros((3, len(texts)), dtype=np.int64)
        for k, t in enumerate(texts):
            words = split_words(t)
            out[0, k] = len(words)
            for found in buckets(words):
                out[1, k] += len(found)
                out[2, k] += by_bucket[found].sum()
        kept = [f for f in batch.schema.names if keep_text or f != text]
        yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in kept), *map(pa.array, out)], names=[*kept, *names])


def noise(id_col: str) -> Column:
    """Gumbel noise in thousandths from the hash of an id, rounded down."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def scores(df: DataFrame, target: DataFrame, names: list[str], id_col: str = "doc_id", text: str = "text",
           keep_text: bool = False) -> DataFrame:
    """``df`` with ``names``: its words, features, weight and score."""
    gain = df.sparkSession.sparkContext.broadcast(gains(bucket_counts(target, text), bucket_counts(df, text)))
    schema = T.StructType([*(f for f in df.schema.fields if keep_text or f.name != text),
                           *(T.StructField(n, T.LongType()) for n in names[:3])])
    weighed = df.mapInArrow(lambda it: _weigh(it, text, gain, names[:3], keep_text), schema)
    return weighed.withColumn(names[3], F.col(names[2]) + noise(id_col))


def _keys(batch: pa.RecordBatch, score: str, tie: str) -> tuple[np.ndarray, np.ndarray]:
    """Ascending keys: the score below zero, then the tie-breaker."""
    def column(name):
        return batch.column(batch.schema.get_field_index(name)).to_numpy()
    return -column(score), column(tie)


def _sample(batches: Iterator[pa.RecordBatch], score: str, tie: str, steps: int) -> Iterator[pa.RecordBatch]:
    """Keys of a sorted run at regular steps, its first among them."""
    found = [_keys(b, score, tie) for b in batches if b.num_rows]
    if found:
        first, second = map(np.concatenate, zip(*found, strict=True))
        at = np.unique(np.arange(steps) * len(first) // steps)
        yield pa.RecordBatch.from_arrays([pa.array(first[at]), pa.array(second[at])], names=["first", "second"])


def _segments(first: np.ndarray, second: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Of keys, how many splitters are at or below each."""
    # the sort is stable, so a splitter stands before keys equal to it
    order = np.lexsort((np.concatenate([splitters[:, 1], second]), np.concatenate([splitters[:, 0], first])))
    is_splitter = order < len(splitters)
    out = np.empty(len(first), dtype=np.int32)
    out[order[~is_splitter] - len(splitters)] = np.cumsum(is_splitter)[~is_splitter]
    return out


def _cut(batches: Iterator[pa.RecordBatch], score: str, tie: str, segment: str, splitters: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = _segments(*_keys(batch, score, tie), splitters)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, segment])


def _number(batches: Iterator[pa.RecordBatch], segment: str, rank: str, before: list[int], last: int) -> Iterator[pa.RecordBatch]:
    """Ranks of the rows of merged segments; null beyond ``last``."""
    passed: dict[int, int] = {}
    for batch in batches:
        at = batch.column(batch.schema.get_field_index(segment)).to_numpy()
        ranks = np.empty(len(at), dtype=np.int64)
        for s in np.unique(at).tolist():                  # one, as a rule: rows come segment by segment
            here = at == s
            n = int(here.sum())
            ranks[here] = before[s] + passed.get(s, 0) + np.arange(1, n + 1)
            passed[s] = passed.get(s, 0) + n
        kept = [f for f in batch.schema.names if f != segment]
        yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in kept), pa.array(ranks, mask=ranks > last)], names=[*kept, rank])


def draw_ranked(df: DataFrame, score: str, id_col: str, rank: str, share: tuple[int, int] = SHARE, segments: int | None = None) -> DataFrame:
    """``df`` with the exact rank of the highest ``share`` (a part, of so many) of its scores, ties to smaller ids; null beyond.

    By regular sampling over the partitions of ``df``, which is read several times: give a stored table.
    """
    spark, tie, segment = df.sparkSession, fresh(df, "tie"), fresh(df, "segment")
    keyed = df.withColumn(tie, F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)))
    order = [F.desc(score), F.asc(tie)]
    runs = keyed.sortWithinPartitions(*order)
    n_runs = max(df.select(F.spark_partition_id().alias("p")).distinct().count(), 1)
    n_segments = segments or n_runs
    steps = max(min(2 * n_segments, SAMPLES // n_runs), 1)
    sampled = runs.select(score, tie).mapInArrow(lambda it: _sample(it, score, tie, steps), "first long, second long").toArrow()
    samples = np.column_stack([c.to_numpy() for c in sampled.columns])
    samples = samples[np.lexsort((samples[:, 1], samples[:, 0]))]
    splitters = np.unique(samples[np.arange(1, n_segments) * len(samples) // n_segments], axis=0) if len(samples) else samples
    cut = stored(runs.mapInArrow(lambda it: _cut(it, score, tie, segment, splitters),
                                 T.StructType([*keyed.schema.fields, T.StructField(segment, T.IntegerType())])), "segments")
    sizes = {r[segment]: r["count"] for r in cut.groupBy(segment).count().collect()}
    before = np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(len(splitters) + 1)])]).tolist()
    last = before[-1] * share[0] // share[1]
    merged = cut.repartitionById(len(splitters) + 1, segment).sortWithinPartitions(segment, *order).drop(tie)
    schema = T.StructType([*df.schema.fields, T.StructField(rank, T.LongType())])
    return spark.createDataFrame([], schema) if not before[-1] else merged.mapInArrow(
        lambda it: _number(it, segment, rank, before, last), schema)


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS,
             share: tuple[int, int] = SHARE, segments: int | None = None, keep_text: bool = False) -> DataFrame:
    """``df`` with n_words, n_features, weight, score and rank (under fresh names where ``df`` has them)."""
    plain, names = df, []
    for n in ("n_words", "n_features", "weight", "score", "rank"):
        names.append(fresh(plain, n))
        plain = plain.withColumn(names[-1], F.lit(None))
    scored = stored(scores(df, target, names[:4], id_col, text, keep_text), "scored")
    drawn = draw_ranked(scored.where(F.col(names[0]) >= least_words), names[3], id_col, names[4], share, segments)
    return drawn.unionByName(scored.where(F.col(names[0]) < least_words).withColumn(names[4], F.lit(None).cast("long")))


@query("op12_target_resampling")
def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, weight, score and rank of every document, drawn towards the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resample(docs, table(spark, sf_dir, "benchmark").select("text")).select("doc_id", "n_features", "weight", "score", "rank")
