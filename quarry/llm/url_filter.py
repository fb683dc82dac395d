"""Operator 7: URL filter by a Bloom filter cascade.

A list has keys ``host + path prefix``; a url meets a key if its host is the key's host or below it and its path starts with
the key's path. The candidate keys of a url (its host suffixes with as many labels as a listed host can
have, times its path prefixes of the lengths that listed paths have) are looked up in a cascade: level 1 is a Bloom filter of the listed keys, level 2 one
of the keys of the corpus that level 1 takes by mistake, level 3 one of the listed keys that level 2 takes, and so on until
no mistake is left. As the cascade is built over the complete universe of the corpus's candidate keys, its answer is
exact for every one of them, without a join.

The universe is cut into segments of about ``SEGMENT_KEYS`` keys by their hash; each segment's cascade is built in one task from
its own keys, which are distinct, so no host or url makes a segment large. What is broadcast is the cascade; its size
is checked, and above ``BROADCAST_BYTES`` it goes out in groups of segments, one pass over the urls for each.

Edge cases: a null url, or one without ``://``, has an empty host and path; repeated rows stay; an empty list or an empty table is
fine; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table

SEGMENT_KEYS = 1 << 20
BROADCAST_BYTES = 64 << 20
LAST_LEVEL = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# fixed values: the rules (host, path, verdict)
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
# fixed values: host words that put a host on the block list
LISTED_WORDS = ["ads", "adult", "bets", "casino", "pills", "spam"]


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER)


def path_of(url: str) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise("")


def candidate_keys(host: str, path: str, labels: int, lengths: list[int]) -> Column:
    """The keys that can hold a url: array<struct<key, host, path>>, longest first, then longest host."""
    parts = F.split(host, r"\.")
    count = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), count), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: F.length(path) >= n) if lengths
                           else F.array().cast("array<int>"), lambda n: F.substr(F.col(path), F.lit(1), n))
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(
        F.concat(h, p).alias("key"), h.alias("host"), p.alias("path")))))
    return F.reverse(F.array_sort(F.transform(pairs, lambda x: F.struct(
        F.length(x["key"]).alias("length"), F.length(x["host"]).alias("host_length"), x["key"].alias("key"),
        x["host"].alias("host"), x["path"].alias("path")))))


def _hashes(keys) -> np.ndarray:
    """(n, 2) unsigned hashes of (host, path) pairs; the separator cannot stand in a host."""
    raw = b"".join(xxhash.xxh3_128_digest(f"{h}\x00{p}".encode()) for h, p in keys)
    return np.frombuffer(raw, dtype=">u8").astype(np.uint64).reshape(-1, 2)


class Bloom:
    """Bits and number of hash functions of one level; ``level`` makes its hash functions its own."""

    def __init__(self, bits: np.ndarray, k: int, level: int):
        self.bits, self.k, self.level, self.size = bits, k, level, len(bits) * 8

    @classmethod
    def of(cls, hashes: np.ndarray, rate: float, level: int) -> Bloom:
        size = max(64, math.ceil(len(hashes) * -math.log(rate) / math.log(2) ** 2))
        size += -size % 8
        self = cls(np.zeros(size // 8, dtype=np.uint8), max(1, round(size / len(hashes) * math.log(2))), level)
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return self

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        salt = np.uint64((0x9E3779B97F4A7C15 * (self.level + 1)) & (2**64 - 1))
        a = (hashes[:, 0] ^ salt) * np.uint64(0xD6E8FEB86659FD93)
        a ^= a >> np.uint64(32)
        b = (hashes[:, 1] ^ a) * np.uint64(0xA0761D6478BD642F) | np.uint64(1)
        b ^= (b >> np.uint64(31)) << np.uint64(1)
        for i in range(self.k):
            x = a + np.uint64(i) * b
            yield ((x >> np.uint64(8)) % np.uint64(self.size)).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for at in self._places(hashes):
            out &= (self.bits[at >> 3] >> (at & 7)) & 1 == 1
        return out


def build_cascade(hashes: np.ndarray, listed: np.ndarray) -> list[Bloom]:
    """Levels for the keys of one segment; ``listed`` marks those on the list. Exact for all of ``hashes``."""
    levels: list[Bloom] = []
    inside, outside = hashes[listed], hashes[~listed]
    while len(inside):
        if len(levels) == LAST_LEVEL:
            raise ValueError("two keys have equal hashes")
        rate = min(0.5, max(1e-9, len(inside) / max(1, len(outside)) / math.sqrt(2))) if not levels else 0.5
        level = Bloom.of(inside, rate, len(levels))
        levels.append(level)
        inside, outside = outside[level.has(outside)], inside
    return levels


def member(levels: list[Bloom], hashes: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed: the first level without a key decides by its parity."""
    out = np.full(len(hashes), len(levels) % 2 == 1)
    open_ = np.ones(len(hashes), dtype=bool)
    for k, level in enumerate(levels):
        misses = open_.copy()
        misses[open_] = ~level.has(hashes[open_])
        out[misses] = k % 2 == 1
        open_ &= ~misses
    return out


CASCADE_SCHEMA = "segment int, list string, level int, k int, bits binary"


def _build_segment(names: list[str]):
    def build(rows: pa.Table) -> pa.Table:
        hashes = np.stack([rows.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2")], axis=1)
        on = rows.column("lists").to_pylist()
        out = []
        for name in names:
            listed = np.array([name in x for x in on], dtype=bool)
            out += [{"segment": rows.column("segment")[0].as_py(), "list": name, "level": x.level, "k": x.k, "bits": x.bits.tobytes()}
                    for x in build_cascade(hashes, listed)]
        return pa.Table.from_pylist(out, schema=pa.schema([("segment", pa.int32()), ("list", pa.string()), ("level", pa.int32()),
                                                           ("k", pa.int32()), ("bits", pa.binary())]))
    return build


def _hash_batches(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h = _hashes(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), b.column(2)], names=["h1", "h2", "lists"])


def cascade(keys: DataFrame, listed: DataFrame, names: list[str]) -> tuple[DataFrame, int]:
    """The cascade (a row per segment, list and level) of ``listed`` (host, path, list) over the universe ``keys`` (host, path), and
    its number of segments."""
    every = (keys.select("host", "path", F.lit(None).cast("string").alias("list"))
             .union(listed.select("host", "path", "list"))
             .groupBy("host", "path").agg(F.collect_set("list").alias("lists")))    # at most one of each name
    hashed = stored(every.mapInArrow(_hash_batches, "h1 bigint, h2 bigint, lists array<string>"), "universe")
    segments = max(1, -(-hashed.count() // SEGMENT_KEYS))
    dealt = hashed.withColumn("segment", F.pmod(F.col("h1"), F.lit(segments)).cast("int"))
    built = dealt.groupBy("segment").applyInArrow(_build_segment(names), CASCADE_SCHEMA)
    return stored(built, "cascade"), segments


def _probe_batches(batches, levels, segments: int, of: list[int], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Adds for every list the place (from 0) of the first candidate on it, unless an earlier pass has one before."""
    cascades: dict[tuple[int, str], list[Bloom]] = {}
    for segment, name, level, k, bits in levels.value:
        cascades.setdefault((segment, name), []).append(Bloom(np.frombuffer(bits, dtype=np.uint8), k, level))
    wanted = set(of)
    for b in batches:
        candidates = b.column(b.schema.get_field_index("candidates")).to_pylist()
        flat = [(c["host"], c["path"]) for cs in candidates for c in cs]
        row = np.repeat(np.arange(b.num_rows), [len(cs) for cs in candidates])
        place = np.concatenate([np.arange(len(cs)) for cs in candidates]) if candidates else np.empty(0, dtype=np.int64)
        h = _hashes(flat)
        segment = np.mod(h[:, 0].view(np.int64), segments)
        out = list(b.columns)
        for name in names:
            at = b.schema.get_field_index(f"on_{name}")
            best = np.array([np.iinfo(np.int32).max if v is None else v for v in out[at].to_pylist()], dtype=np.int32)
            for s in np.unique(segment):
                if int(s) in wanted and (int(s), name) in cascades:
                    here = np.nonzero(segment == s)[0]
                    hit = here[member(cascades[int(s), name], h[here])]
                    np.minimum.at(best, row[hit], place[hit].astype(np.int32))
            out[at] = pa.array(best, pa.int32(), mask=best == np.iinfo(np.int32).max)
        yield pa.RecordBatch.from_arrays(out, names=b.schema.names)


def probe(urls: DataFrame, levels: DataFrame, segments: int, names: list[str]) -> DataFrame:
    """``urls`` (with ``candidates``) with ``on_<list>``: the place of its first candidate key on the list, or null."""
    sizes = {r.segment: r.n for r in levels.groupBy("segment").agg(F.sum(F.length("bits")).alias("n")).collect()}
    groups, held = [[]], 0
    for s in sorted(sizes):
        if groups[-1] and held + sizes[s] > BROADCAST_BYTES:
            groups.append([])
            held = 0
        groups[-1].append(s)
        held += sizes[s]
    out = urls.withColumns({f"on_{n}": F.lit(None).cast("int") for n in names})
    for group in groups:
        rows = [tuple(r) for r in levels.where(F.col("segment").isin(group)).orderBy("segment", "list", "level").collect()]
        shared = urls.sparkSession.sparkContext.broadcast(rows)    # BROADCAST_BYTES at most, or one segment's cascade
        out = out.mapInArrow(lambda it, shared=shared, group=group: _probe_batches(it, shared, segments, group, names), out.schema)
    return out


def judge(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: id, host, path, ``rule`` (the longest rule that holds it, else null) and ``verdict``.

    ``listed`` (host, path, list) has rules (lists ``block`` and ``allow``) and a block list (``blocked``): the longest rule decides,
    ties by the longer host; without one, a page on the block list is blocked and any other allowed.
    """
    names = ["allow", "block", "blocked"]
    listed = stored(listed.select("host", "path", "list").distinct(), "listed")
    bounds = listed.agg(F.max(F.size(F.split("host", r"\."))).alias("labels"),
                        F.collect_set(F.length("path")).alias("lengths")).first()   # as many as there are path lengths
    parts = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    parts = parts.withColumn("candidates", candidate_keys("host", "path", bounds.labels or 0, sorted(bounds.lengths)) if bounds.labels
                             else F.array().cast("array<struct<length:int,host_length:int,key:string,host:string,path:string>>"))
    universe = parts.select(F.explode("candidates").alias("c")).select("c.host", "c.path").distinct()
    levels, segments = cascade(universe, listed, names)
    seen = probe(parts, levels, segments, names)
    place = F.least("on_allow", "on_block")
    rule = F.get("candidates", place)
    return seen.select(F.col("id").alias(id_col), "host", "path", F.when(place.isNotNull(), rule["key"]).alias("rule"),
                       F.when(place.isNull(), F.when(F.col("on_blocked").isNotNull(), "block").otherwise("allow"))
                       .when(F.col("on_block") == place, "block").otherwise("allow").alias("verdict"))


def listed_hosts(pages: DataFrame, words: list[str], url: str = "url") -> DataFrame:
    """(host, path, list): every host of the pages with one of the words between its dots and hyphens, as a block-list key."""
    pattern = r"(?:^|[.-])(?:" + "|".join(words) + r")(?:[.-]|$)"
    return (pages.select(host_of(url).alias("host")).distinct().where(F.col("host").rlike(pattern))
            .select("host", F.lit("").alias("path"), F.lit("blocked").alias("list")))


def _sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    return f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {rules}),
rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(r, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), judged AS (
    SELECT page_id, arg_max(rule_host || rule_path, (length(rule_host || rule_path), length(rule_host))) AS rule,
           arg_max(verdict, (length(rule_host || rule_path), length(rule_host))) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN judged USING (page_id)
"""


@query("op7_url_filter", _sql())
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict; pages without a rule by the listed hosts of the table."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, list string")
    return judge(pages, rules.union(listed_hosts(pages, LISTED_WORDS)))
