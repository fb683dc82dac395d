"""Operator 11: phrase collocations of each language, by best-first branch-and-bound growth.

A phrase (2 to ``LONGEST`` words within a piece) scores ``SCALE * a / (l + r)`` at its weakest cut, a being its own count and l and r those of the
two parts. Counts of prefixes and suffixes bound what growth can reach: a phrase has no more occurrences than any part of it, and
``a / (a + l)`` grows with a, so no phrase that starts with x y can score above ``SCALE * f(x y) / (f(x y) + f(x))``, and likewise at its other end.

Words and frequent pairs are counted first; both are exact tables that stay with Spark. Then the frontier grows in
steps of falling bounds (``STEPS``): a step counts the longer phrases whose bounds reach it, with all that decide whether a phrase of such a score
survives, and scores them exactly. A language is settled when its ``top``-th surviving score is at or above the step, since
nothing unexpanded can then reach or tie with it; the last step has no bound. Settled languages take no part in further steps.

The texts are scanned once for words, once for pairs and once a step. A scan knows the counts from tables of fixed size (``WORD_BITS``, ``PAIR_BITS``),
broadcast: every cell holds the highest and the lowest count, in quarters of a power of two, of what is hashed to it. So a bound read
there is never too low; a collision costs work, not a result. Exact counts come from shuffled partial sums of the phrases themselves.

A phrase falls to a longer one around it if that has four fifths of its count; one more word before or after is enough to look at, since what
lies between a phrase and a longer one around it has no fewer occurrences than the longer one.

Edge cases: a null or empty text has no words; a null language is ``und``, the same as one so named; repeated rows count as often as
they stand there; ties are ordered by count and phrase; other columns are left out; an empty table gives no row. A text is scanned in blocks that
end with a piece, so memory grows with the longest piece only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_volume, claim, query, stored, table

# fixed values: the phrases asked for
TOP = 2000
LEAST = 30
LONGEST = 4
SCALE = 2_000_000
UNKNOWN = "und"

STEPS = (500_000, 60_000, 0)         # scores; the last must be 0
WORD_BITS, PAIR_BITS = 20, 22
TEXT_PER_BLOCK = 4 << 20
HELD = 400_000                       # distinct words a task holds before it gives them on
ODD = np.uint64(0x9E3779B97F4A7C15)

BREAK = b"\xff"                      # not a byte of UTF-8
_plain = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256)).lower()


def _blocks(texts: list[bytes]) -> Iterator[bytes]:
    """All texts in lower case with BREAK between pieces, a word by itself, some megabytes at a time."""
    data = BREAK.join(texts).translate(_plain)
    at = 0
    while at < len(data):
        end = at + TEXT_PER_BLOCK
        if end < len(data):
            found = data.rfind(BREAK, at, end)
            end = found + 1 if found >= 0 else data.find(BREAK, end) + 1 or len(data)
        yield data[at:end].replace(BREAK, b" \xff ")
        at = end


def token_blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """The words of all texts with BREAK between pieces, some megabytes at a time."""
    for block in _blocks(texts):
        yield block.split()


class Block:
    """The tokens of a block, words and BREAK, each different one once: ``words``, and their numbers ``ids`` in order, from 1 on; 0 is BREAK."""

    def __init__(self, lang: str, block: bytes):
        tokens = pc.ascii_split_whitespace(pa.array([block], pa.binary()).view(pa.string())).flatten()
        real = pc.greater(pc.binary_length(tokens), 0)           # white space at an end leaves an empty word there
        tokens = (tokens if pc.all(real).as_py() else tokens.filter(real)).dictionary_encode()
        self.lang, self.words = lang, tokens.dictionary
        self.ids = tokens.indices.to_numpy().astype(np.int64) + 1
        self.breaks = pc.index(self.words.view(pa.binary()), pa.scalar(BREAK)).as_py() + 1
        if self.breaks:
            self.ids[self.ids == self.breaks] = 0

    def hashes(self) -> np.ndarray:
        """The hash of every token, 0 of BREAK."""
        lang = self.lang.encode() + b"\x00"
        words = self.words.view(pa.binary()).to_numpy(zero_copy_only=False)
        found = np.zeros(len(words) + 1, dtype=np.uint64)
        found[1:] = np.fromiter(map(xxhash.xxh3_64_intdigest, [lang + w for w in words]), dtype=np.uint64, count=len(words))
        return found[self.ids]

    def counts(self) -> tuple[pa.Array, np.ndarray]:
        """(different words, the number of each)."""
        found = np.bincount(self.ids, minlength=len(self.words) + 1)[1:]
        if not self.breaks:
            return self.words, found
        kept = np.flatnonzero(found)                             # BREAK was numbered and stands nowhere
        return self.words.take(pa.array(kept)), found[kept]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of rows (lang, text)."""
    for batch in by_volume(batches, "text", TEXT_PER_BLOCK):
        texts: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if text:
                texts.setdefault(lang, []).append(text)
        for lang, found in texts.items():
            for block in _blocks(found):
                yield Block(lang, block)


def _rows(lang: str, size: int, phrases: pa.Array, counts) -> pa.RecordBatch:
    n = len(phrases)
    return pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), phrases, pa.array(counts, pa.int64())],
                                      names=["lang", "size", "phrase", "f"])


COUNTS = "lang string, size int, phrase string, f long"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim({})
    held: dict[str, list[pa.Table]] = {}
    for block in _by_lang(batches):
        words, counts = block.counts()
        held.setdefault(block.lang, []).append(pa.table({"phrase": words, "f": counts}))
        if sum(t.num_rows for found in held.values() for t in found) > 2 * HELD:
            held = {lang: [_merged(found)] for lang, found in held.items()}
            if sum(t.num_rows for (t,) in held.values()) > HELD:
                yield from _words_held(held)
                held.clear()
    yield from _words_held(held)


def _merged(found: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(found).group_by("phrase", use_threads=False).aggregate([("f", "sum")]).select(["phrase", "f_sum"]).rename_columns(["phrase", "f"])


def _words_held(held: dict[str, list[pa.Table]]) -> Iterator[pa.RecordBatch]:
    for lang, found in held.items():
        for part in _merged(found).to_batches():
            yield _rows(lang, 1, part.column(0), part.column(1))


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\x00" + word)


def pair_hash(first, second):
    """Of two arrays of word hashes; orders differ."""
    return (first * ODD + second) * ODD


class Bounds:
    """Upper and lower counts by cell of a hash; 0 where nothing is."""

    steps = np.concatenate([[0.0], 2.0 ** (np.arange(255) / 4)])      # class c stands for 2 ** ((c - 1) / 4)

    def __init__(self, bits: int, cells: np.ndarray, high: np.ndarray, low: np.ndarray):
        self.shift = np.uint64(64 - bits)
        self.high, self.low = np.zeros(1 << bits, dtype=np.uint8), np.zeros(1 << bits, dtype=np.uint8)
        self.high[cells], self.low[cells] = high, low

    def read(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = hashes >> self.shift
        return self.steps[self.high[cells]], self.steps[self.low[cells]]


def _cells(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Cell, upper and lower class of rows (lang, phrase, f) of words or pairs."""
    for batch in batches:
        hashes = [[word_hash(lang, w) for w in phrase.split(b" ")]
                  for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)]
        hashes = np.array(hashes, dtype=np.uint64).T
        if hashes.size:
            found = hashes[0] if len(hashes) == 1 else pair_hash(*hashes)
            exact = np.log2(batch.column(2).to_numpy()) * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array((found >> np.uint64(64 - bits)).astype(np.int64)), pa.array(np.ceil(exact - 1e-9).astype(np.int16) + 1),
                 pa.array(np.floor(exact + 1e-9).astype(np.int16) + 1)], names=["cell", "high", "low"])


def bounds(counts: DataFrame, bits: int) -> Bounds:
    """The table of bounds of counted words or pairs: at most 2 ** bits rows reach the driver."""
    found = (counts.select("lang", "phrase", "f").mapInArrow(lambda it: _cells(it, bits), "cell long, high short, low short")
             .groupBy("cell").agg(F.max("high").alias("high"), F.min("low").alias("low")).toArrow())
    return Bounds(bits, *(c.to_numpy() for c in found.columns))


def _scan(batches: Iterator[pa.RecordBatch], found_in) -> Iterator[pa.RecordBatch]:
    """Partial counts: ``found_in(ids, hashes)`` gives (size, word numbers by place) of the occurrences that a block has."""
    claim({})
    for block in _by_lang(batches):
        for size, occurrences in found_in(block.ids, block.hashes()):
            if not len(occurrences[0]):
                continue
            # a phrase's number is that of its first words, then its last word: 64 bits hold both exactly
            number, parts = occurrences[0], []
            for column in occurrences[1:-1]:
                keys, number = np.unique(number << 32 | column, return_inverse=True)
                parts.append(keys)
            keys, counts = np.unique(number << 32 | occurrences[-1], return_counts=True)
            parts.append(keys)
            phrases = block.words.take(pa.array((parts[0] >> 32) - 1))
            for keys in parts:
                if keys is not parts[0]:
                    phrases = phrases.take(pa.array(keys >> 32))
                phrases = pc.binary_join_element_wise(phrases, block.words.take(pa.array((keys & 0xFFFFFFFF) - 1)), " ")
            yield _rows(block.lang, size, phrases, counts)


def _pairs_in(ids: np.ndarray, hashes: np.ndarray, words: Bounds):
    frequent = (words.read(hashes)[0] > 0) & (ids > 0)
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    yield 2, [ids[at], ids[at + 1]]


def _longer_in(ids: np.ndarray, hashes: np.ndarray, words: Bounds, pairs: Bounds, step: int):
    """Occurrences of three and four words that may matter at scores of ``step`` and more."""
    if len(ids) < 3:
        return
    frequent = (words.read(hashes)[0] > 0) & (ids > 0)
    both = frequent[:-1] & frequent[1:]
    at = np.flatnonzero(both[:-1] & both[1:])                   # three frequent words from here
    first, second = pairs.read(pair_hash(hashes[at], hashes[at + 1])), pairs.read(pair_hash(hashes[at + 1], hashes[at + 2]))
    real = (first[0] > 0) & (second[0] > 0)
    at, (h1, l1), (h2, l2) = at[real], (x[real] for x in first), (x[real] for x in second)
    w = [words.read(hashes[at + k])[1] for k in range(3)]       # lower counts of the words
    least = (step - 1.0) / SCALE * (1 - 1e-9)
    most = np.minimum(h1, h2)                                   # of the three words' count
    own = np.minimum(most / (w[0] + l2), most / (l1 + w[2]))
    around = ((h1 / (w[0] + w[1]) >= least) & (5 * h2 >= 4 * l1)) | ((h2 / (w[1] + w[2]) >= least) & (5 * h1 >= 4 * l2))
    chosen = (own >= least) | (most / (w[0] + most) >= least) | (most / (most + w[2]) >= least) | around
    yield 3, [ids[at[chosen] + k] for k in range(3)]
    follows = np.flatnonzero(np.diff(at) == 1)                  # three words here and three from the next word: four
    if len(follows):
        most4 = np.minimum(most[follows], h2[follows + 1])
        own4 = np.minimum(np.minimum(most4 / (w[0][follows] + most4), most4 / (l1[follows] + l2[follows + 1])),
                          most4 / (most4 + w[2][follows + 1]))
        chosen = (own4 >= least) | (own[follows] >= least) | (own[follows + 1] >= least)
        yield 4, [ids[at[follows[chosen]] + k] for k in range(4)]


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def score_phrases(phrases: DataFrame, counts: DataFrame, step: int = 0) -> DataFrame:
    """(lang, size, phrase, a, l, r, score) of the phrases that score at least ``step``: the lowest-scoring cut, the first among equals.

    ``counts`` (lang, phrase, f) has the parts of all phrases that can reach ``step``; a phrase with a part that is not there cannot.
    """
    words = F.split("phrase", " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("size") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice(words, F.lit(1), k), " ").alias("first"),
        F.array_join(F.slice(words, k + 1, F.col("size") - k), " ").alias("rest")))
    cut = phrases.select("lang", "size", "phrase", F.col("f").alias("a"), F.inline(cuts))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr(f"cast({SCALE} as decimal(10,0)) * cast(a as decimal(20,0)) div cast(l + r as decimal(20,0))")
    each = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", score)
    best = (each.groupBy("lang", "size", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.count(F.lit(1)).alias("n_cuts")))
    return (best.where((F.col("n_cuts") == F.col("size") - 1) & (F.col("cut.score") >= step))
            .select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def surviving(scored: DataFrame, longer: DataFrame) -> DataFrame:
    """``scored`` without the phrases that have one of ``longer`` (lang, size, phrase, f) around them with four fifths of their count."""
    words = F.split("phrase", " ")
    inner = longer.select("lang", "f", F.explode(F.array(
        F.array_join(F.slice(words, F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    return scored.join(most, ["lang", "phrase"], "left").where("most IS NULL OR 5 * most < 4 * a").drop("most")


def mine(df: DataFrame, lang: str = "lang", text: str = "text", top: int = TOP, least: int = LEAST,
         steps: tuple[int, ...] = STEPS) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text")).where("text <> ''")
    every = stored(_summed(docs.mapInArrow(_count_words, COUNTS)), "words")
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    words = every.where(F.col("f") >= least)
    word_table = spark.sparkContext.broadcast(bounds(words, WORD_BITS))
    pairs = stored(_summed(docs.mapInArrow(lambda it: _scan(it, lambda i, h: _pairs_in(i, h, word_table.value)), COUNTS))
                   .where(F.col("f") >= least), "pairs")
    pair_table = spark.sparkContext.broadcast(bounds(pairs, PAIR_BITS))
    scored_pairs = stored(score_phrases(pairs, words), "scored")
    rest, results = docs, []
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    for step in steps:
        def longer_in(ids, hashes, step=step):
            return _longer_in(ids, hashes, word_table.value, pair_table.value, step)
        longer = stored(_summed(rest.mapInArrow(lambda it, find=longer_in: _scan(it, find), COUNTS)).where(F.col("f") >= least), "longer")
        here = scored_pairs.where(F.col("score") >= step).unionByName(
            score_phrases(longer, words.unionByName(pairs).unionByName(longer), step))
        left = surviving(here, longer)
        ranked = stored(left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top), "ranked")
        results.append((step, ranked))
        if step == steps[-1]:
            break
        settled = ranked.where(F.col("rank") == top).select("lang")
        rest = rest.join(settled, "lang", "left_anti")
        scored_pairs = scored_pairs.join(settled, "lang", "left_anti")
        if rest.isEmpty():
            break
    done = None
    for step, ranked in results:
        whole = ranked if step == results[-1][0] else ranked.join(ranked.where(F.col("rank") == top).select("lang"), "lang", "left_semi")
        done = whole if done is None else done.unionByName(whole)
    return done.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
pieces AS (SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(pieces) AS p FROM docs)),
runs AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
counts AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS words, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT lang, k, words, f FROM counts WHERE f >= 30),
cuts AS (SELECT lang, k, words, f AS a, unnest(range(1, k)) AS c FROM frequent WHERE k >= 2),
each AS (SELECT t.lang, t.k, t.words, t.a, t.c, x.f AS l, y.f AS r, (2000000::HUGEINT * t.a // (x.f + y.f))::BIGINT AS score
         FROM cuts t JOIN frequent x ON x.lang = t.lang AND x.words = list_slice(t.words, 1, t.c)
         JOIN frequent y ON y.lang = t.lang AND y.words = list_slice(t.words, t.c + 1, t.k)),
best AS (SELECT * FROM each QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, c) = 1),
inner_ AS (SELECT lang, f, unnest([list_slice(words, 1, k - 1), list_slice(words, 2, k)]) AS words FROM frequent WHERE k >= 3),
around AS (SELECT lang, words, max(f) AS most FROM inner_ GROUP BY ALL),
left_ AS (SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.score
          FROM best b LEFT JOIN around o ON o.lang = b.lang AND o.words = b.words WHERE o.most IS NULL OR 5 * o.most < 4 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op11_phrase_mining", SQL)
def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of every language."""
    return mine(table(spark, sf_dir, "documents").select("lang", "text"))
