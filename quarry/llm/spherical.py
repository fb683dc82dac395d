"""Operator 2: embedding near-dedup by spherical-cap filters.

Filters are directions of structured random product codes: the space is turned by a random rotation and cut into
``m`` blocks, every block has ``b`` random unit codewords, and each of the ``b ** m`` tuples of codewords is a filter.
Several rotations, each with its own code, even out how a vector's length falls on the blocks.
A vector is list-decoded to all filters whose direction it meets at or above a cosine ``alpha`` - block by block, with the best rest
as a bound, so that no tuple is looked at in vain. Two vectors at cosine 0.95 or more share several filters almost
surely; they meet in the filter's list and their cosine is verified in double precision.

``alpha`` follows from the number of vectors by the exact distribution of a random cosine: a filter holds ``LIST``
unrelated vectors on average whatever the table's size, and a vector stands on about ``FILTERS`` lists.

Equal vectors are one class from the start. A list longer than ``BLOCK`` is cut into blocks by a hash of the id, and
tasks compare pairs of blocks, so a large group of near copies is spread and never in one task. No
pairs are written: a comparison adds to its vectors' link counts (in the smallest filter that the pair shares, so once)
and writes the links of a spanning star for the components.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different lengths
never link; a row without id takes no part (no component, not kept); rows with the same id are one
node of the components; other columns are left out.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import query, stored, table
from .components import components

COSINE = 0.95
FILTERS = 32        # filters a vector is expected to exceed
ROTATIONS = 16
LIST = 16           # unrelated vectors expected on a filter's list
BLOCK = 1024        # longer lists are compared in blocks of about this many
WORDS_PER_BLOCK = 128
SEED = 2
DECODED = 4096      # vectors decoded at a time


def cap_cosine(share: float, d: int) -> float:
    """The cosine that a random direction in ``d`` dimensions reaches with probability ``share``."""
    if d < 2:
        return 1.0
    angles = np.linspace(0.0, math.pi, 400_001)
    density = np.sin(angles) ** (d - 2)
    mass = np.cumsum(density)
    return float(np.cos(angles[np.searchsorted(mass / mass[-1], min(share, 1.0))]))


class ProductCode:
    """Random filters for vectors of ``d`` dimensions, alike in every process."""

    def __init__(self, d: int, n_vectors: int):
        share = min(0.25, LIST / max(n_vectors, 1))
        total = FILTERS / share / ROTATIONS
        self.m = max(1, min(d // 2 or 1, math.ceil(math.log(max(total, 2)) / math.log(WORDS_PER_BLOCK))))
        total *= max(1, self.m - 1)      # more blocks are less even: more filters make up for it
        self.b = math.ceil(total ** (1 / self.m))
        self.least = cap_cosine(share, d) * math.sqrt(self.m)
        rng = np.random.default_rng([SEED, d, self.m, self.b])
        cuts = np.linspace(0, d, self.m + 1).astype(int)
        self.blocks = list(zip(cuts[:-1], cuts[1:], strict=True))
        self.rotations = [np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(ROTATIONS)]
        self.words = []
        for _ in range(ROTATIONS):
            words = [rng.standard_normal((self.b, hi - lo)) for lo, hi in self.blocks]
            self.words.append([w / np.linalg.norm(w, axis=1, keepdims=True) for w in words])

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """The ascending numbers of all filters that each unit vector exceeds."""
        found = [self._decode(units, r) for r in range(ROTATIONS)]
        return [np.concatenate([f[v] + r * self.b ** self.m for r, f in enumerate(found)]) for v in range(len(units))]

    def _decode(self, units: np.ndarray, r: int) -> list[np.ndarray]:
        turned = units @ self.rotations[r]
        products = [turned[:, lo:hi] @ w.T for (lo, hi), w in zip(self.blocks, self.words[r], strict=True)]
        orders = [np.argsort(-p, axis=1) for p in products]
        ranked = [np.take_along_axis(p, o, axis=1) for p, o in zip(products, orders, strict=True)]
        # the best that the blocks from j on can add
        rest = np.zeros((len(units), self.m + 1))
        for j in range(self.m - 1, -1, -1):
            rest[:, j] = rest[:, j + 1] + ranked[j][:, 0]
        none = np.empty(0, dtype=np.int64)
        out = [none] * len(units)
        for v in np.nonzero(rest[:, 0] >= self.least)[0]:
            sums, numbers = np.zeros(1), np.zeros(1, dtype=np.int64)
            for j in range(self.m):
                need = self.least - rest[v, j + 1] - sums
                fits = np.searchsorted(-ranked[j][v], -need, side="right")
                at = np.arange(fits.sum()) - np.repeat(np.cumsum(fits) - fits, fits)
                numbers = np.repeat(numbers, fits) * self.b + orders[j][v][at]
                sums = np.repeat(sums, fits) + ranked[j][v][at]
            out[v] = np.sort(numbers)
        return out


@functools.lru_cache(maxsize=16)
def _code(d: int, n_vectors: int) -> ProductCode:
    return ProductCode(d, n_vectors)


def _units(vectors: list) -> np.ndarray:
    x = np.array(vectors, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)       # squares neither over- nor underflow
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(values: np.ndarray, short: type) -> bytes:
    """The values' bytes, in the short type where it holds them exactly; :func:`_unpacked` tells by the length."""
    small = values.astype(short)
    return (small if np.array_equal(small.astype(values.dtype), values) else values).tobytes()


def _unpacked(raw: bytes, n: int, long: type, short: type) -> np.ndarray:
    return np.frombuffer(raw, dtype=long if len(raw) == n * np.dtype(long).itemsize else short).astype(long)


def _decode_batches(batches, n_vectors: int) -> Iterator[pa.RecordBatch]:
    """(rep, size, vector, sign) to a row per filter: (d, filter, rep, size, vector, n_filters, filters, sign)."""
    for whole in batches:
        for lo in range(0, whole.num_rows, DECODED):
            batch = whole.slice(lo, DECODED)
            reps, sizes, vectors, signs = (batch.column(i).to_pylist() for i in range(4))
            by_length: dict[int, list[int]] = {}
            for k, v in enumerate(vectors):
                by_length.setdefault(len(v), []).append(k)
            for d, own in by_length.items():
                lists = _code(d, n_vectors).decode(_units([vectors[k] for k in own]))
                times = np.array([len(x) for x in lists])
                rows = np.repeat(np.arange(len(own)), times)
                raw = [_packed(np.array(vectors[k], dtype=np.float64), np.float32) for k in own]
                packed = [_packed(x, np.uint32) for x in lists]
                for s in range(0, len(rows), 4096):
                    part = rows[s:s + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), d, dtype=np.int32)), pa.array(np.concatenate(lists)[s:s + 4096]),
                         pa.array([reps[own[r]] for r in part], pa.int64()), pa.array([sizes[own[r]] for r in part], pa.int64()),
                         pa.array([raw[r] for r in part], pa.binary()), pa.array(times[part], pa.int32()),
                         pa.array([packed[r] for r in part], pa.binary()), pa.array([signs[own[r]] for r in part], pa.int64())],
                        names=["d", "filter", "rep", "size", "vector", "n_filters", "filters", "sign"])


DECODED_SCHEMA = "d int, filter bigint, rep bigint, size bigint, vector binary, n_filters int, filters binary, sign bigint"
FOUND_SCHEMA = "rep bigint, sign bigint, links bigint, v bigint"


def _shared_before(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray, filter_no: int) -> np.ndarray:
    """For pairs (left[i], right[j]): whether they share a filter of a smaller number."""
    width = max((int((x < filter_no).sum()) for x in (*left, *right)), default=0)
    if width == 0:
        return np.zeros(len(i), dtype=bool)

    def padded(lists, fill):
        out = np.full((len(lists), width), fill, dtype=np.int64)
        for k, x in enumerate(lists):
            x = x[x < filter_no]
            out[k, :len(x)] = x
        return out

    a, b, out = padded(left, -1), padded(right, -2), np.zeros(len(i), dtype=bool)
    step = max(1, (1 << 22) // (width * width))
    for s in range(0, len(i), step):
        out[s:s + step] = (a[i[s:s + step]][:, :, None] == b[j[s:s + step]][:, None, :]).any(axis=(1, 2))
    return out


def _compare(key, rows: list[tuple], cosine: float) -> Iterator[pa.RecordBatch]:
    """One list, or one pair of its blocks: link counts of its vectors and a spanning star of its links."""
    d, filter_no, lo, hi = key
    left = [r for r in rows if r[0] == lo]
    right = left if lo == hi else [r for r in rows if r[0] == hi]
    if not left or not right or (lo == hi and len(left) < 2):
        return
    x, y = (_units([_unpacked(r[3], d, np.float64, np.float32) for r in side]) for side in (left, right))
    linked = x @ y.T >= cosine
    if lo == hi:
        linked = np.triu(linked, 1)
    i, j = np.nonzero(linked)
    if not len(i):
        return
    lists = [[_unpacked(r[5], r[4], np.int64, np.uint32) for r in side] for side in (left, right)]
    first = ~_shared_before(lists[0], lists[1], i, j, filter_no)
    ids = [np.array([r[1] for r in side], dtype=np.int64) for side in (left, right)]
    sizes = [np.array([r[2] for r in side], dtype=np.int64) for side in (left, right)]
    # a star in place of the links: every vector with the smallest id of its part of this list
    parent = {int(v): int(v) for v in np.concatenate(ids)}

    def root(v):
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        return v

    for p, q in zip(ids[0][i].tolist(), ids[1][j].tolist(), strict=True):
        p, q = root(p), root(q)
        if p != q:
            parent[max(p, q)] = min(p, q)
    totals = [np.zeros(len(side), dtype=np.int64) for side in (left, right)]
    if lo == hi:
        totals[1] = totals[0]
    np.add.at(totals[0], i[first], sizes[1][j[first]])
    np.add.at(totals[1], j[first], sizes[0][i[first]])
    for k, side in enumerate((left,) if lo == hi else (left, right)):
        at = np.unique(np.concatenate([i, j]) if lo == hi else (i, j)[k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[k][at]), pa.array([side[r][6] for r in at], pa.int64()), pa.array(totals[k][at]),
             pa.array([root(int(v)) for v in ids[k][at]], pa.int64())], names=["rep", "sign", "links", "v"])


def _compare_batches(batches, cosine: float) -> Iterator[pa.RecordBatch]:
    """Rows (d, filter, lo, hi, block, rep, size, vector, n_filters, filters, sign), those of one (d, filter, lo, hi) together."""
    key, held = None, []
    for batch in batches:
        for d, filter_no, lo, hi, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (d, filter_no, lo, hi) != key:
                if key is not None:
                    yield from _compare(key, held, cosine)
                key, held = (d, filter_no, lo, hi), []
            held.append(tuple(row))
    if key is not None:
        yield from _compare(key, held, cosine)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """Per row of ``df``: its id, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id reachable by
    links, itself included) and ``kept`` (it is that smallest id)."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))) & ~F.isnan(x))
    usable = F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
                     F.coalesce(usable, F.lit(False)).alias("usable"))
    classes = stored(rows.where("usable").groupBy("vector").agg(F.min("id").alias("rep"), F.count("id").alias("size"))
                     .select("rep", "size", "vector", F.xxhash64("vector").alias("sign")), "vectors")
    n_vectors = 1 << max(0, classes.count() - 1).bit_length()     # a power of two: one code for tables of like size
    entries = classes.mapInArrow(lambda it: _decode_batches(it, n_vectors), DECODED_SCHEMA)
    entries = stored(entries, "filters")
    # only lists above BLOCK have an entry here, so the join is a small one as a rule
    long_lists = entries.groupBy("d", "filter").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK).select(
        "d", "filter", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = (entries.join(long_lists, ["d", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "d", "filter", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "rep", "size", "vector", "n_filters", "filters", "sign")
    key = ["d", "filter", "lo", "hi"]
    found = stored(dealt.repartition(*key).sortWithinPartitions(*key)
                   .mapInArrow(lambda it: _compare_batches(it, cosine), FOUND_SCHEMA), "found")

    counts = found.groupBy("rep", "sign").agg(F.sum("links").alias("links"))
    member = stored(rows.where("usable").join(classes.withColumnRenamed("vector", "class_vector"),
                                              F.col("vector") == F.col("class_vector")).select("id", "rep", "sign", "size"), "members")
    same_id = member.groupBy("id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).where("u > v").select("u", "v")
    parts = components(found.select(F.col("rep").alias("u"), "v").union(same_id)).withColumnRenamed("node", "rep")
    linked = member.join(counts, ["rep", "sign"], "left").join(parts, "rep", "left").select(
        "id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    alone = rows.where("NOT usable").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


@query("op2_embedding_dedup")
def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
