"""Operator 10: n-gram Jaccard join, size-aware with a light and a heavy side.

A document's set is its distinct word shingles, as 64-bit hashes. Equal sets become one class first, so
a large group of exact copies is one row from then on. In one order of all shingles (rarest first),
two sets of the wanted similarity share two shingles among their first ``n - t + 2`` and one among
their first ``n - t + 1`` (``t``: the least overlap a set of ``n`` can have with a partner).

* Light sets (small) enumerate the 2-subsets of their longer prefix; two light sets meet where they
  have such a subset in common.
* Heavy sets (large) stand on the inverted lists of the shingles of their shorter prefix and meet
  whatever set is on the same list: heavy ones, and light ones large enough to be a partner.
* The boundary is the size from which enumeration costs more than scanning, by the table of sizes and the
  list lengths that the shingle counts of the whole corpus predict.

Candidates pass exact filters (sizes, and the popcount of two parity bitmaps, which never exceeds
the symmetric difference) and are then verified on whole sets. To avoid all pairs of a large group of near
copies, every list first links its members to its smallest id; the components of the verified
links are formed; and only the members of lists that still span several components are looked at again, between
components. Such a list is first cut by ranges of sizes (:func:`levels`): a set stands at its own level and, as a guest, at the one below,
so that linked sets have a level in common, and what spans one component only or holds only guests is settled, and of several lists with the same members (the shingles of a passage that the
same texts share) one stays. Lists of few members (:func:`_long`) are joined with themselves, so what they cost grows with the members, and a pair leaves the join only if
its bitmaps of up to ``64 * WIDE`` bits allow a link. A longer list, of
texts that have little but a passage in common, is not: its sets are cut by
a hash into one part more than the elements in which two linked ones of their level can differ, so that linked ones have a part in common as
a whole, and members meet where such a part is the same. A part that is empty counts within one list only. No
link is lost: a pair that stays unverified is in one component already.

The shingle counts are one row of a count-min sketch of fixed width (``SKETCH`` integers, its size never grows
with the corpus). They only set the order; any order gives the same result.

Edge cases: a null or empty text has no shingles and links with nothing; a text with fewer words than
a shingle is one shingle of its own; a row without id is returned with no component; rows with the
same id are one document that links through each of its texts; other columns are dropped.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_volume, claim, query, stored, table
from .components import components

SKETCH = 1 << 18
BUCKET_SHIFT = np.uint64(64 - 18)
LIGHT_LIMIT = 256               # sizes below this may be light
SHORT_LIST, LONG_LIST = 32, 1000      # an open list is joined with itself up to the first, never beyond the second
FOLDED = 4                      # 64-bit words of the short parity bitmap
WIDE = 16                       # 64-bit words at most of the bitmap that members of open lists carry
TEXT_PER_BATCH = 4 << 20
CACHED_WORDS = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)
PLACES = np.array([0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F],
                  dtype=np.uint64)


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked when den * |A n B| >= num * |A u B|."""
    words: int = 5
    num: int = 80
    den: int = 100

    def least_overlap(self, n: int) -> int:
        """The least overlap that a set of ``n`` can have with any partner."""
        return -(-self.num * n // self.den)

    def prefix(self, n: int, shared: int) -> int:
        return min(n, n - self.least_overlap(n) + shared)

    def alone(self, n: int) -> bool:
        """No set of another content can be a partner."""
        return self.least_overlap(n) == n and self.den * n // self.num == n


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * MIX
    return x ^ (x >> np.uint64(29))


def window_hashes(words: list[bytes], k: int) -> np.ndarray:
    """A hash of every run of ``k`` words, in text order."""
    w = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = max(0, len(w) - k + 1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total += _mixed(w[j:j + n] ^ PLACES[j % len(PLACES)] + np.uint64(j // len(PLACES)))
        total *= MIX
    return _mixed(total)


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending. ASCII letters are lower-cased, ASCII white space splits."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b"\x20".join(words), seed=len(words))], dtype=np.uint64)
    return np.unique(window_hashes(words, k))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(ids, texts as bytes) of bounded batches with the columns id, text."""
    claim(_hashes)
    for batch in by_volume(batches, "text", TEXT_PER_BATCH):
        yield batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()


def _count_batches(batches, k: int) -> Iterator[pa.RecordBatch]:
    counts, sizes = np.zeros(SKETCH, dtype=np.int64), np.zeros(LIGHT_LIMIT + 1, dtype=np.int64)
    for _, texts in _texts(batches):
        found = []
        for t in texts:
            s = shingles(t, k)
            found.append(s)
            sizes[min(len(s), LIGHT_LIMIT)] += 1
        counts += np.bincount((np.concatenate(found) >> BUCKET_SHIFT).astype(np.int64), minlength=SKETCH)
    step = 1 << 14
    parts = [*(counts[i:i + step] for i in range(0, SKETCH, step)), sizes]
    yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()),
                                      pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))], names=["part", "counts"])


def _sum_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in parts:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            c = counts.values.to_numpy()
            sums[part] = sums[part] + c if part in sums else c
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))],
                                         names=["part", "counts"])


def corpus_counts(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences by hash bucket of all shingles of all documents, and the number of sets by size (fixed lengths)."""
    schema = "part int, counts array<bigint>"
    per_task = docs.mapInArrow(lambda it: _count_batches(it, k), schema)
    parts = SKETCH // (1 << 14) + 1
    summed = per_task.repartition(parts, "part").mapInArrow(_sum_counts, schema).collect()  # `parts` rows
    by_part = {r.part: np.array(r.counts, dtype=np.int64) for r in summed}
    counts = np.concatenate([by_part[i] for i in range(parts - 1)]) if by_part else np.zeros(SKETCH, dtype=np.int64)
    return counts, by_part.get(parts - 1, np.zeros(LIGHT_LIMIT + 1, dtype=np.int64))


def light_limit(rule: Rule, counts: np.ndarray, sizes: np.ndarray) -> int:
    """The largest size whose sets enumerate 2-subsets.

    A light set of ``n`` writes C(p2, 2) rows. A heavy one writes p1 rows, and each meets the others on its list: at
    least the one it looks for, and what the rarest shingles of the corpus (the share that prefixes cover) have in
    excess of an even spread. A boundary also makes light sets just below it write list rows.
    """
    ordered = np.sort(counts)
    occurrences = np.cumsum(ordered)
    rare = occurrences <= max(1, (1 - rule.num / rule.den) * occurrences[-1])
    even = counts.mean()
    excess = np.maximum(ordered[rare] - even - 3 * np.sqrt(even), 0)
    met = 1 + (float((excess * ordered[rare]).sum() / max(1, ordered[rare].sum())) if rare.any() else 0.0)
    n = np.arange(LIGHT_LIMIT)
    p1 = np.array([rule.prefix(int(i), 1) for i in n])
    p2 = np.array([rule.prefix(int(i), 2) for i in n])
    heavy, light = sizes[:-1] * p1 * (1 + met), sizes[:-1] * p2 * (p2 - 1) / 2
    cost = [light[:b + 1].sum() + heavy[int(np.ceil(rule.num / rule.den * (b + 1))):].sum() for b in range(LIGHT_LIMIT - 1)]
    return int(np.argmin(cost))


def _keys(s: np.ndarray, rule: Rule, counts: np.ndarray, light: int) -> np.ndarray:
    """The lists that a set stands on: subsets if light, shingles if heavy or large enough for a heavy partner."""
    n = len(s)
    if n == 0 or rule.alone(n):
        return np.empty(0, dtype=np.uint64)
    order = np.lexsort((s, counts[(s >> BUCKET_SHIFT).astype(np.int64)]))
    out = []
    if n <= light:
        first = s[order[:rule.prefix(n, 2)]]
        i, j = (np.array(x, dtype=np.int64) for x in zip(*itertools.combinations(range(len(first)), 2), strict=True)) \
            if len(first) > 1 else (np.empty(0, dtype=np.int64),) * 2
        out.append(_mixed(_mixed(first[i] + MIX) + first[j]))
    if n > light or rule.den * n >= rule.num * (light + 1):
        out.append(s[order[:rule.prefix(n, 1)]])
    return np.unique(np.concatenate(out))


def _parity(s: np.ndarray) -> np.ndarray:
    """A parity bitmap of between n and 2n bits (a power of two, 256 at least) as 64-bit words: bit i tells whether an
    odd number of the hashes are i modulo its length. Two sets' bitmaps differ in at most as many bits as the sets."""
    size = 64 * FOLDED
    while size < len(s):
        size *= 2
    bits = np.bincount(((s >> np.uint64(8)) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def _folded(bits: np.ndarray) -> np.ndarray:
    """The bitmap of the same set with 64 * FOLDED bits."""
    return np.bitwise_xor.reduce(bits.reshape(-1, FOLDED), axis=0)


def _at_most(bits: str, words: int) -> F.Column:
    """The bitmap column, folded to ``words`` 64-bit words if it has more."""
    blocks = F.transform(F.sequence(F.lit(0), (F.size(bits) / words).cast("int") - 1), lambda k: F.slice(bits, k * words + 1, F.lit(words)))
    folded = F.aggregate(blocks, F.array_repeat(F.lit(0).cast("long"), words), lambda x, y: F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q)))
    return F.when(F.size(bits) > words, folded).otherwise(F.col(bits))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0] + [len(v) for v in values], dtype=np.int32)
    flat = np.concatenate(values).view(np.int64) if values else np.empty(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _signature_batches(batches, rule: Rule, counts, light: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in _texts(batches):
        sets = [shingles(t, rule.words) for t in texts]
        bitmaps = [_parity(s) for s in sets]
        prints = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()),
             _lists([_keys(s, rule, counts.value, light) for s in sets]), _lists(bitmaps),
             _lists([_folded(b) for b in bitmaps])],
            names=["id", "n", "fp1", "fp2", "keys", "bits", "folded"])


def _set_batches(batches, k: int) -> Iterator[pa.RecordBatch]:
    for ids, texts in _texts(batches):
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists([shingles(t, k) for t in texts])],
                                         names=["rep", "members"])


def level_starts(rule: Rule, largest: int = 1 << 40) -> list[int]:
    """The least size of every level. Levels are ranges of sizes such that a set's larger partners are in its own level or the next."""
    starts = [1]
    while starts[-1] <= largest:
        starts.append(rule.den * starts[-1] // rule.num + 1)
    return starts


def levels(rule: Rule, n: int) -> list[tuple[int, int]]:
    """(level, parts) of a set of ``n``, its own level and the one below. Two sets that link have a level in common and, there, fewer different
    elements than parts."""
    starts = level_starts(rule, n)
    own = len(starts) - 2
    out = []
    for level in range(own, max(own - 2, -1), -1):
        out.append((level, _n_parts(rule, starts[level + 1] - 1)))
    return out


def _n_parts(rule: Rule, most: int) -> int:
    """Parts of the sets of a level whose largest have ``most`` elements."""
    return (rule.den - rule.num) * (most + rule.den * most // rule.num) // (rule.den + rule.num) + 1


def _long(rule: Rule, level: str, members: str) -> F.Column:
    """Whether a list is better cut into parts: joined with itself, a member meets half the others, cut, it makes as many rows as parts."""
    pairs = F.array(*[F.lit(min(2 * _n_parts(rule, x - 1), LONG_LIST)) for x in level_starts(rule)[1:]])
    return F.col(members) > F.greatest(F.lit(SHORT_LIST), F.get(pairs, F.col(level)))


def _own_level(rule: Rule, n: str) -> F.Column:
    starts = F.array(*[F.lit(x).cast("long") for x in level_starts(rule)])
    return F.size(F.filter(starts, lambda x: x <= F.col(n))) - 1


def _parts(s: np.ndarray, rule: Rule) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(level, keys of the parts of a set, keys of those that are empty), for each of its levels."""
    out = []
    for level, parts in levels(rule, len(s)):
        seed = np.uint64((level * 0x9E3779B97F4A7C15 + 0xD1B54A32D192ED03) & (1 << 64) - 1)
        mixed = _mixed(s ^ seed)
        place = ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        there, start = np.unique(place[order], return_index=True)
        sums = np.add.reduceat(_mixed(mixed[order] + PLACES[0]), start)
        gone = np.setdiff1d(np.arange(parts), there)
        out.append((level, _mixed(sums ^ _mixed(there.astype(np.uint64) + seed)), _mixed(_mixed(gone.astype(np.uint64) + seed) + PLACES[1])))
    return out


def _part_batches(batches, rule: Rule) -> Iterator[pa.RecordBatch]:
    for ids, texts in _texts(batches):
        found = [(i, *part) for i, t in zip(ids, texts, strict=True) for part in _parts(shingles(t, rule.words), rule)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32()),
             _lists([f[2] for f in found]), _lists([f[3] for f in found])], names=["rep", "level", "full", "empty"])


def _differ_little(rule: Rule, differ: F.Column) -> F.Column:
    """As the common part is num/den of the union at least, the sets differ in at most (den-num)/(den+num) of both sizes."""
    return differ * (rule.den + rule.num) <= (rule.den - rule.num) * (F.col("n_a") + F.col("n_b"))


def _may_link(rule: Rule) -> F.Column:
    """Exact filter on (n_a, folded_a, n_b, folded_b): a linked pair passes."""
    differ = functools.reduce(lambda x, y: x + y, [
        F.bit_count(F.col("folded_a")[i].bitwiseXOR(F.col("folded_b")[i])) for i in range(FOLDED)])
    return (rule.num * F.greatest("n_a", "n_b") <= rule.den * F.least("n_a", "n_b")) & _differ_little(rule, differ)


def _may_link_by_bits(rule: Rule) -> F.Column:
    """The same with the whole bitmaps; partners' lengths are equal or one is folded once."""
    a, b = F.col("bits_a"), F.col("bits_b")

    def half(x):
        n = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), n), F.slice(x, n + 1, n), lambda p, q: p.bitwiseXOR(q))

    short_a = F.when(F.size(a) > F.size(b), half(a)).otherwise(a)
    short_b = F.when(F.size(b) > F.size(a), half(b)).otherwise(b)
    differ = F.aggregate(F.zip_with(short_a, short_b, lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda x, y: x + y)
    return F.when(F.size(short_a) == F.size(short_b), _differ_little(rule, differ)).otherwise(True)


def _verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b) whose whole sets are as similar as the rule asks, as links (u, v)."""
    pairs = stored(pairs, "candidates")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(docs.join(wanted, "id", "left_semi").select("id", "text")
                  .mapInArrow(lambda it: _set_batches(it, rule.words), "rep bigint, members array<bigint>"), "sets")
    both = (pairs.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("of_b")), "b")
            .join(sets.select(F.col("rep").alias("a"), F.col("members").alias("of_a")), "a"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (both.where(rule.den * common >= rule.num * (F.size("of_a") + F.size("of_b") - common))
            .select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())


def near_components(df: DataFrame, id_col: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Per row of ``df``: its id, ``n_shingles``, ``class_id`` (smallest id with an equal set) and ``component_id``
    (smallest id reachable by links, itself included)."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    counts, sizes = corpus_counts(docs, rule.words)
    light, shared_counts = light_limit(rule, counts, sizes), spark.sparkContext.broadcast(counts)
    signed = stored(docs.mapInArrow(
        lambda it: _signature_batches(it, rule, shared_counts, light),
        "id bigint, n bigint, fp1 bigint, fp2 bigint, keys array<bigint>, bits array<bigint>, folded array<bigint>"), "signatures")

    classes = stored(signed.where("n > 0 AND id IS NOT NULL").groupBy("fp1", "fp2", "n")
                     .agg(F.min("id").alias("rep"), F.first("keys").alias("keys"), F.first("bits").alias("bits"),
                          F.first("folded").alias("folded")), "classes")
    posted = classes.select("rep", "n", F.explode("keys").alias("key"))
    lists = posted.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a < last").drop("last")
    met = stored(posted.join(lists, "key").select("key", "a", F.col("rep").alias("b"), "n"), "lists")

    def side(x):
        return classes.select(F.col("rep").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "bits", "folded")])

    def plausible(pairs):
        return (pairs.join(side("b"), "b").join(side("a"), "a")
                .where(_may_link(rule) & _may_link_by_bits(rule)).select("a", "b").distinct())

    first = _verified(plausible(met.where("a <> b").select("a", "b").distinct()), docs, rule)
    member = signed.where("id IS NOT NULL").select("id", "n", "fp1", "fp2").join(
        classes.select("fp1", "fp2", "n", "rep"), ["fp1", "fp2", "n"])
    same_id = member.groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).where("u > v").select("u", "v")
    grown = stored(components(first.union(same_id)), "components")

    placed = (met.select("key", F.col("b").alias("rep"), "n").join(grown.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    at_levels = stored(placed.join(several, "key").withColumn("own", _own_level(rule, "n")).select(
        "key", "rep", "component", "own", F.explode(F.when(F.col("own") > 0, F.array("own", F.col("own") - 1)).otherwise(F.array("own"))).alias("level")), "spanning")
    native = F.max(F.col("own") == F.col("level")).alias("native")                 # guests meet each other at their own level
    one, other = F.xxhash64("rep", "own"), F.xxhash64("own", "rep")
    mark = {"sum_high": F.sum(F.shiftrightunsigned(one, 32)).alias("sum_high"), "sum_low": F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum_low"),
            "xor": F.bit_xor(other).alias("xor")}                                    # of a list's members in any order
    spans = at_levels.groupBy("key", "level").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("members"), native, *mark.values()) \
        .where("lo < hi AND native").groupBy("level", "members", *mark).agg(F.min("key").alias("key")) \
        .select("key", "level", _long(rule, "level", "members").alias("long"))
    open_lists = stored(at_levels.join(spans, ["key", "level"]), "open-lists")
    long_lists = open_lists.where("long")
    places = stored(long_lists.select("rep", "level", "own", "component").distinct(), "places")     # its real size decides whether texts are shuffled
    parts = stored(docs.join(places.select(F.col("rep").alias("id")), "id", "left_semi")
                   .mapInArrow(lambda it: _part_batches(it, rule), "rep bigint, level int, full array<bigint>, empty array<bigint>"), "parts") \
        .join(places, ["rep", "level"])
    lead = ["rep", "level", "own", "component"]
    empty = parts.select(*lead, F.explode("empty").alias("part")).distinct().join(long_lists.select("rep", "level", "key"), ["rep", "level"]) \
        .select(*lead, F.xxhash64("key", "part").alias("part"))
    members = parts.select(*lead, F.explode("full").alias("part")).union(empty).distinct()
    shared = members.groupBy("part").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), native).where("lo < hi AND native")
    meeting = members.join(shared.select("part"), "part", "left_semi").select(*lead, "part") \
        .union(open_lists.where("NOT long").select(*lead, F.xxhash64("key", "level").alias("part")))
    again = stored(meeting.join(classes.select("rep", "n", "folded", _at_most("bits", WIDE).alias("bits")), "rep"), "meeting")

    def end(x):
        return again.select("part", "level", *[F.col(c).alias(f"{c}_{x}" if c != "rep" else x) for c in ("rep", "component", "own", "n", "folded", "bits")])

    across = (end("a").join(end("b"), ["part", "level"])
              .where((F.col("a") < F.col("b")) & (F.col("component_a") != F.col("component_b"))
                     & (F.col("level") == F.least("own_a", "own_b")) & _may_link(rule) & _may_link_by_bits(rule))
              .select("a", "b").distinct())
    second = _verified(plausible(across), docs, rule)
    final = components(second.union(grown.select(F.col("node").alias("u"), F.col("component").alias("v"))))
    known = classes.select("fp1", "fp2", "n", "rep").join(final.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("fp1", "fp2", "n", "rep", F.coalesce("component", "rep").alias("component"))
    return (signed.select("id", "n", "fp1", "fp2").join(known, ["fp1", "fp2", "n"], "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("class_id"),
                    F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id")))


@query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under Jaccard >= 0.85 of 4-word shingles."""
    return near_components(table(spark, sf_dir, "documents"), rule=Rule(4, 85, 100)).select(
        "doc_id", "n_shingles", "component_id")
