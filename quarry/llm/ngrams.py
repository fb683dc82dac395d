"""Hashed n-gram features of a text, for the two operators that fit generative models on them.

A text's tokens are its word parts (runs of letters and digits) and its runs of other signs, lower-cased. Its features are the
distinct buckets of: all tokens, all pairs of adjacent tokens of the whole text, the first five characters of longer tokens, a mark for
words in capitals and, for each of ``ECHOES``, how many of its pairs are said again that many places on and no nearer, in powers of two (``w w w``
says the pair ``w w`` again one place on, ``a b a b`` the pair ``a b`` two). Presence is what counts, not frequency, so repeated passages
and long texts weigh no more than others. Pairs have buckets of their own, so that their number does not drown the tokens.
"""

from __future__ import annotations

import itertools
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim

TOKEN_BITS, PAIR_BITS = 18, 20      # tokens have the first buckets, pairs the rest: a long text has thousands of rare pairs
TOKENS = 1 << TOKEN_BITS
BUCKETS = TOKENS + (1 << PAIR_BITS)
BUCKET_BITS = BUCKETS.bit_length()
SHIFT, PAIR_SHIFT = 64 - TOKEN_BITS, 64 - PAIR_BITS
PART = 1 << 14           # counts travel in parts of this many buckets
PARTS_PER_BATCH = 8      # of which so many go to the JVM at once
STEM = 5
ECHOES = (1, 2, 3)
ODD = 0x9E3779B97F4A7C15      # a pair hashes to ODD * first + second
NONE = -1
CACHED_WORDS = 100_000
TEXT_PER_BATCH = 1 << 19  # bytes of text cut at once

END = "\n"               # of a word, between words
_piece = re.compile(r"\w+|[^\w\s]+|\n")
_digest = xxhash.xxh3_64_intdigest


def _hash(feature: str) -> int:
    return _digest(feature)


def bucket(feature: str) -> int:
    return _hash(feature) >> SHIFT


def pair_bucket(first: int, second: int) -> int:
    """Of the hashes of two adjacent tokens; orders differ."""
    return TOKENS + (((ODD * first + second) & (1 << 64) - 1) >> PAIR_SHIFT)


CAPITALS = bucket("\x00capitals")
#: by distance and number of binary digits of how many pairs are said again
ECHO = {k: np.array([bucket(f"\x00echo {k} {power}") for power in range(64)]) for k in ECHOES}


def new_task() -> None:
    """At the start of a task: other operators' caches go."""
    claim(_tokens)


class _Numbers(defaultdict):
    """Numbers of what is looked up, in the order of its first time."""

    def __init__(self):
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.default_factory = itertools.count().__next__

    def after(self, n: int) -> list:
        """All but the first ``n``."""
        return [*itertools.islice(self, n, None)]


class _Tokens(_Numbers):
    """Tokens as they stand in words, by number: under a number stand the token's hash in lower case, its stem's bucket (NONE if it has none)
    and whether it is in capitals. 0 is the end of a word."""

    def clear(self) -> None:
        super().clear()
        self.stems = _Stems()
        self.hashes, self.stem, self.capitals = array("Q", [0]), array("i", [NONE]), array("b", [self[END]])

    def learn(self) -> None:
        """What stands under the numbers that came in last."""
        tokens = self.after(len(self.hashes))
        lows = [*map(str.lower, tokens)]
        self.hashes.extend(map(_digest, lows))
        stem = np.full(len(lows), NONE, dtype=np.int32)
        long = np.fromiter(map(len, lows), dtype=np.int64, count=len(lows)) > STEM
        stem[long] = [*map(self.stems.__getitem__, [low[:STEM] for low in lows if len(low) > STEM])]
        self.stem.frombytes(stem.tobytes())
        capitals = np.fromiter(map(str.isupper, tokens), dtype=np.int8, count=len(lows))
        for k in np.flatnonzero(capitals).tolist():
            capitals[k] = len(tokens[k]) > 1
        self.capitals.frombytes(capitals.tobytes())


class _Words(_Numbers):
    """Words (runs of bytes without ASCII white space) as they stand in texts, by number; under a number stand the first and the last of the word's
    tokens, which have numbers of their own. Between texts, more than CACHED_WORDS are forgotten."""

    def clear(self) -> None:
        super().clear()
        self.known = _Tokens()
        self.first, self.token = array("i", [0]), array("i")

    def _cut(self) -> None:
        """The tokens of the words that came in last."""
        unseen = [*self.after(len(self.first) - 1), b""]
        found = _piece.findall(END.encode().join(unseen).decode("utf-8", "replace"))          # no word holds END
        numbers = np.fromiter(map(self.known.__getitem__, found), dtype=np.int32, count=len(found))
        self.known.learn()
        ends = np.flatnonzero(numbers == 0)
        self.first.frombytes((ends - np.arange(len(ends)) + len(self.token)).astype(np.int32).tobytes())
        self.token.frombytes(numbers[numbers != 0].tobytes())

    def tokens(self, words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the numbers of the tokens of the ``words`` at ``places``, in order, the number of each word's)."""
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))
        if len(self) >= len(self.first):
            self._cut()
        first, at = np.frombuffer(self.first, dtype=np.int32), at[places]
        start, sizes = first[at], first[at + 1] - first[at]
        ends = sizes.cumsum(dtype=np.int64)
        inner = np.arange(ends[-1] if len(ends) else 0) + (start - ends + sizes).repeat(sizes)
        return np.frombuffer(self.token, dtype=np.int32)[inner], sizes


class _Stems(dict):
    def __missing__(self, stem: str) -> int:
        found = self[stem] = bucket("\x00" + stem)
        return found


_tokens = _Words()


def features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts: (their distinct buckets, one text after the other and in order, bounds of each text's, number of words of each)."""
    cut = pc.ascii_split_whitespace(texts.view(pa.string()))
    words, doc = cut.flatten(), pc.list_parent_indices(cut).to_numpy().astype(np.int64)
    real = pc.binary_length(words).to_numpy() > 0               # beside white space at the ends stand empty words
    if not real.all():
        words, doc = words.filter(pa.array(real)), doc[real]
    n = np.bincount(doc, minlength=len(texts))
    words = words.dictionary_encode()
    if len(_tokens) > CACHED_WORDS:
        _tokens.clear()
    distinct = words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)
    at, sizes = _tokens.tokens(distinct, words.indices.to_numpy())
    doc = doc.repeat(sizes)
    known = _tokens.known
    hashes, stems = np.frombuffer(known.hashes, dtype=np.uint64)[at], np.frombuffer(known.stem, dtype=np.int32)[at]
    capitals = np.zeros(len(texts), dtype=bool)
    capitals[doc[np.frombuffer(known.capitals, dtype=np.int8)[at] != 0]] = True
    pairs = np.uint64(ODD) * hashes[:-1] + hashes[1:]
    mark = doc << BUCKET_BITS                         # a text's buckets stand together when sorted
    whole, stemmed = doc[:-1] == doc[1:], stems != NONE
    found = [mark | (hashes >> np.uint64(SHIFT)).astype(np.int64), mark[stemmed] | stems[stemmed],
             mark[:-1][whole] | ((pairs[whole] >> np.uint64(PAIR_SHIFT)).astype(np.int64) + TOKENS),
             np.flatnonzero(capitals) << BUCKET_BITS | CAPITALS]
    nearer = np.zeros(len(pairs), dtype=bool)
    for k in ECHOES:
        again = (pairs[k:] == pairs[:-k]) & ~nearer[k:] & (doc[:-k - 1] == doc[k + 1:])
        nearer[k:] |= again
        echoes = np.bincount(doc[k + 1:][again], minlength=len(texts))
        some = np.flatnonzero(echoes)
        found.append(some << BUCKET_BITS | ECHO[k][np.frexp(echoes[some])[1]])            # the exponent: binary digits
    every = np.concatenate(found)
    every.sort()
    every = every[np.diff(every, prepend=-1) != 0]
    bounds = np.searchsorted(every, np.arange(len(texts) + 1, dtype=np.int64) << BUCKET_BITS)
    return (every & ((1 << BUCKET_BITS) - 1)).astype(np.int32), bounds, n


def features(text: bytes | None) -> tuple[np.ndarray, int]:
    """(distinct buckets in order, number of words) of a text in UTF-8."""
    found, _, n = features_of(pa.array([text], pa.binary()))
    return found, int(n[0])


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The sum of ``values`` between each two bounds."""
    total = np.zeros(len(bounds) - 1, dtype=values.dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        total[some] = np.add.reduceat(values, bounds[some])
    return total


def weigh_pairs(weights: np.ndarray) -> np.ndarray:
    """``weights`` (buckets last) with those of the pairs centred and halved.

    Centred, the pairs of a long text that meet others in their buckets add nothing on average, however many they are; halved, since
    every token stands in two pairs, a token's pairs weigh as much as one n-gram.
    """
    pairs = weights[..., TOKENS:]
    return np.concatenate([weights[..., :TOKENS], (pairs - pairs.mean(axis=-1, keepdims=True)) / 2], axis=-1)


def label_sample(labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids, chosen by a hash of the id: (label_id, quality, toxic, holdout).

    The bound makes it safe to broadcast. Several labels of an id become one (worst quality, most toxic); rows with a null
    are left out. A fifth of the ids is the holdout.
    """
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
           .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    order = F.xxhash64(F.col("doc_id"), F.lit(5))
    return (one.orderBy(order, "doc_id").limit(rows)
            .select(F.col("doc_id").alias("label_id"), "quality", "toxic", (F.pmod(order, F.lit(5)) == 0).alias("holdout")))


def count_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Stacked arrays of BUCKETS counts in parts, a few in each batch: (part, counts)."""
    for first in range(0, len(counts) // PART, PARTS_PER_BATCH):
        flat = counts[first * PART:(first + PARTS_PER_BATCH) * PART].astype(np.int64)
        n = len(flat) // PART
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(first, first + n), pa.int32()),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * PART), pa.array(flat))],
            names=["part", "counts"])


COUNT_SCHEMA = "part int, counts array<bigint>"


def _sum_parts(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            c = counts.values.to_numpy()
            sums[part] = sums[part] + c if part in sums else c.copy()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))],
                                         names=["part", "counts"])


def summed(counted: DataFrame, arrays: int) -> list[np.ndarray]:
    """The sums over all tasks of what :func:`count_rows` gave; ``arrays`` * BUCKETS numbers whatever the corpus."""
    n = arrays * BUCKETS // PART
    rows = {r.part: np.array(r.counts, dtype=np.int64)
            for r in counted.repartition(-(-n // 4), "part").mapInArrow(_sum_parts, COUNT_SCHEMA).collect()}
    flat = np.concatenate([rows.get(k, np.zeros(PART, dtype=np.int64)) for k in range(n)])
    return np.split(flat, arrays)
