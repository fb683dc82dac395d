"""Operator 13: toxic spans and document scores by a linear-chain conditional random field.

The field tags every word of a text as toxic or not. A word's evidence is the sum of the weights of its features, the word itself and
its first 3 to 8 letters, in lower case; two neighbouring tags have a weight for each pair of tags. Forward-backward gives every word its
marginal; runs of words at ``SPAN`` or more are the offending spans, and the largest log odds and the expected number of tagged words, put through a logistic
curve, give the document's score.

The labels are of documents, so words get theirs by distant supervision: in a toxic text, those with a feature that at least ``SEED_SHARE``
of its texts have under the toxic label and that is beyond chance, after correction for the number of features tested, are toxic; all others are not. Copies would make any word look toxic:
of texts with an equal minimum hash of their five-word shingles, three hashes in turn, one is used. Training runs on at most ``FIT_ROWS`` labelled texts, whole ones, as
a Spark job a step: every task sums the gradient over its sequences, the driver holds the weights of the features beyond chance.

A batch's words are one chain, cut by start weights where a text begins. It is laid out as a grid of equal pieces, whose transfer matrices are multiplied all at once, linked
in order, and gone through forwards and backwards all at once; so a text of any length is exact and vectorised. Texts are not shuffled, and labels, languages and ids are no inputs of a score.

Edge cases: a null or empty text, or one without letters, has no spans and the score of no evidence; without a training row of each class the field
is empty and every score is the (smoothed) share of toxic rows, 0 without any row; a null id is held out; rows of one id are scored each by its own text; several labels of an
id are toxic if one is; null labels are left out; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_volume, claim, fresh, query, stored, table

FOLDS = 5                # labels of fold 0 are held out
FIT_ROWS = 10_000        # labelled rows used at most
PREFIXES = tuple(range(3, 9))
LEAST_ROWS = 3           # toxic training texts with a feature
SEED_SHARE = 0.5
ITERATIONS = 25
RATE, SHRINK = 1.0, 1e-3
SPAN = 0.5
EDGE = 12.0              # log odds are cut there
SHINGLE, MIN_HASHES = 5, 3
TEXT_PER_BATCH = 2 << 20
CACHED_WORDS = 300_000
HELD = 500_000
SPANS = "array<struct<start:int,end:int,score:double>>"

_word = re.compile(r"[^\W\d_]+")
OTHERS = 5               # weights beside the features': bias, start, and the tag pairs (no, toxic), (toxic, no), (toxic, toxic)


def held_out(id_col: str) -> Column:
    """Whether an id's labels are kept from training."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def features(word: str) -> list[str]:
    """Of a word as it stands in a text."""
    low = word.lower()
    return ["=" + low, *(low[:k] for k in PREFIXES if len(low) >= k)]


# --- forward-backward -------------------------------------------------------------------------------------------------------------------

def marginals(evidence: np.ndarray, starts: np.ndarray, others: np.ndarray, pairs: bool = False):
    """(marginal of the toxic tag of each word, expected number of each tag pair) of a chain.

    ``evidence``: log odds of each word without bias; ``starts``: where a text begins (the first word must); ``others``: bias, start and pair weights.
    """
    n = len(evidence)
    if not n:
        return np.empty(0), np.zeros((2, 2))
    bias, start, no_yes, yes_no, yes_yes = others
    length = max(int(math.sqrt(n)), 1)
    rows = -(-n // length)
    odds = np.ones(rows * length)
    odds[:n] = np.exp(np.clip(evidence + bias, -30, 30))
    begin = np.ones(rows * length, dtype=bool)             # padding: texts of one word each
    begin[:n] = starts
    odds, begin = np.ascontiguousarray(odds.reshape(rows, length).T), np.ascontiguousarray(begin.reshape(rows, length).T)
    m00, m10 = np.ones(odds.shape), np.where(begin, 1.0, math.exp(yes_no))
    m01, m11 = odds * np.where(begin, math.exp(start), math.exp(no_yes)), odds * np.where(begin, math.exp(start), math.exp(yes_yes))
    # what each piece of the chain does to any state before it
    p = np.ones(rows), np.zeros(rows), np.zeros(rows), np.ones(rows)
    for t in range(length):
        p = (p[0] * m00[t] + p[1] * m10[t], p[0] * m01[t] + p[1] * m11[t], p[2] * m00[t] + p[3] * m10[t], p[2] * m01[t] + p[3] * m11[t])
        size = p[0] + p[1] + p[2] + p[3]
        p = tuple(x / size for x in p)
    into, after = np.empty((rows, 2)), np.empty((rows, 2))
    into[0], after[-1] = (1.0, 0.0), (1.0, 1.0)
    links = np.stack(p, axis=1).reshape(rows, 2, 2)
    for k in range(rows - 1):
        v = into[k] @ links[k]
        into[k + 1] = v / v.sum()
    for k in range(rows - 1, 0, -1):
        v = links[k] @ after[k]
        after[k - 1] = v / v.sum()
    a0, a1 = into.T.copy()
    yes = np.empty((length + 1, rows))                     # share of the toxic tag, seen from the left
    yes[0] = a1 / (a0 + a1)
    for t in range(length):
        n0, n1 = a0 * m00[t] + a1 * m10[t], a0 * m01[t] + a1 * m11[t]
        size = n0 + n1
        a0, a1 = n0 / size, n1 / size
        yes[t + 1] = a1
    b0, b1 = after.T.copy()
    out, seen = np.empty((length, rows)), np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        both = yes[t + 1] * b1
        out[t] = both / (both + (1 - yes[t + 1]) * b0)
        n0, n1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
        if pairs:
            before = yes[t]
            share = np.where(begin[t], 0.0, 1.0 / ((1 - before) * n0 + before * n1))
            seen += [[((1 - before) * m00[t] * b0 * share).sum(), ((1 - before) * m01[t] * b1 * share).sum()],
                     [(before * m10[t] * b0 * share).sum(), (before * m11[t] * b1 * share).sum()]]
        size = n0 + n1
        b0, b1 = n0 / size, n1 / size
    return out.T.reshape(-1)[:n], seen


# --- training ---------------------------------------------------------------------------------------------------------------------------

def _min_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_volume(batches, "text", TEXT_PER_BATCH):
        out = []
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            words = _word.findall((text or "").lower())
            shingles = {" ".join(words[i:i + SHINGLE]) for i in range(max(len(words) - SHINGLE + 1, 1))}
            hashes = np.array([xxhash.xxh3_64_intdigest(s) for s in shingles], dtype=np.uint64)
            out.append([int((hashes * np.uint64(odd)).min() >> np.uint64(1)) for odd in (1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)])
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[k] for r in out], pa.int64()) for k in range(MIN_HASHES))],
                                         names=[*batch.schema.names, *(f"h{k}" for k in range(MIN_HASHES))])


def training_texts(df: DataFrame, labels: DataFrame, id_col: str, text: str, fit_rows: int) -> DataFrame:
    """(text, toxic) of at most ``fit_rows`` labelled rows that are not held out, near copies left out; chosen by hashes."""
    one = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("own_id"))
           .agg((F.max("toxic") == 1).alias("toxic")).where(~held_out("own_id")))
    order = F.xxhash64("own_id", F.lit(13))
    sample = one.orderBy(order, "own_id").limit(fit_rows)                    # safe to broadcast
    rows = (df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(sample), F.col("doc_id") == F.col("own_id"))
            .select("own_id", "text", "toxic", F.xxhash64("text").alias("print")))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(f"h{k}", T.LongType()) for k in range(MIN_HASHES))])
    hashed = stored(rows.mapInArrow(_min_hashes, schema), "hashed")
    kept = hashed.select("own_id", "print", "toxic", *(f"h{k}" for k in range(MIN_HASHES)))
    for k in range(MIN_HASHES):
        kept = (kept.groupBy(f"h{k}", "toxic").agg(F.min(F.struct("own_id", "print", *(f"h{j}" for j in range(MIN_HASHES) if j != k))).alias("row"))
                .select(f"h{k}", "toxic", "row.*"))
    kept = kept.orderBy(order, "own_id", "print").limit(fit_rows).select("own_id", "print")     # an id may have many texts
    return stored(hashed.join(kept, ["own_id", "print"], "left_semi").dropDuplicates(["own_id", "print"]).select("text", "toxic"), "training")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    claim({})
    every, toxic = Counter(), Counter()

    def rows():
        names = list(every)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([every[f] for f in names], pa.int64()),
                                           pa.array([toxic[f] for f in names], pa.int64())], names=["feature", "n", "n_toxic"])
    for batch in by_volume(batches, "text", TEXT_PER_BATCH):
        for text, is_toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = {f for w in set(_word.findall(text or "")) for f in features(w)}
            every.update(found)
            if is_toxic:
                toxic.update(found)
            if len(every) > HELD:
                yield rows()
                every.clear()
                toxic.clear()
    if every:
        yield rows()


def choose_features(train: DataFrame, n: int, n_toxic: int) -> dict[str, bool]:
    """The features whose texts are toxic more or less often than chance gives, and whether they are seeds."""
    share = n_toxic / n
    counted = stored(train.select("text", "toxic").mapInArrow(_count_features, "feature string, n long, n_toxic long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic")).where(F.col("n") >= LEAST_ROWS), "features")
    tested = counted.count()
    clean = F.col("n") - F.col("n_toxic")

    def term(seen, p):
        return F.when(seen > 0, seen * F.log(seen / (F.col("n") * F.lit(p)))).otherwise(0.0)
    likelihood = 2 * (term(F.col("n_toxic"), share) + term(clean, 1 - share))
    toxic_share = F.col("n_toxic") / F.col("n")
    seed = (toxic_share >= max(SEED_SHARE, (1 + share) / 2)) & (F.col("n_toxic") >= LEAST_ROWS)
    rows = counted.where(likelihood >= 2 * math.log(max(tested, 1)) + 2).select("feature", seed.alias("seed")).collect()
    return {r.feature: r.seed for r in rows}


def _sequences(batches: Iterator[pa.RecordBatch], chosen) -> Iterator[pa.RecordBatch]:
    """Of every text: its length, and where its words with chosen features are, which features those are and which words are toxic."""
    known, seeds = chosen.value
    for batch in by_volume(batches, "text", TEXT_PER_BATCH):
        out = []
        for text, is_toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            at, numbers, gold = [], [], []
            words = _word.findall(text or "")
            for k, w in enumerate(words):
                for f in features(w):
                    if f in known:
                        at.append(k)
                        numbers.append(known[f])
                        if is_toxic and f in seeds and (not gold or gold[-1] != k):
                            gold.append(k)
            if words:
                out.append({"n": len(words), "at": at, "feature": numbers, "gold": gold})
        yield pa.RecordBatch.from_pylist(out, schema=pa.schema([("n", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("at", "feature", "gold"))]))


def _flat(column: pa.ListArray, offsets: np.ndarray) -> np.ndarray:
    """The values of lists, each with its row's offset added."""
    sizes = column.value_lengths().to_numpy()
    return column.flatten().to_numpy() + np.repeat(offsets, sizes)


def _gradient(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    n_features, total = len(weights) - OTHERS, np.zeros(len(weights))
    for batch in batches:
        if not batch.num_rows:
            continue
        size = batch.column(0).to_numpy()
        begin = np.cumsum(size) - size
        at, feature, gold = _flat(batch.column(1), begin), batch.column(2).flatten().to_numpy(), _flat(batch.column(3), begin)
        n = int(size.sum())
        evidence = np.bincount(at, weights[feature], minlength=n)
        starts, tags = np.zeros(n, dtype=bool), np.zeros(n)
        starts[begin], tags[gold] = True, 1.0
        chance, expected = marginals(evidence, starts, weights[n_features:], pairs=True)
        off = tags - chance
        total[:n_features] += np.bincount(feature, off[at], minlength=n_features)
        left, right, linked = tags[:-1], tags[1:], ~starts[1:]
        total[n_features:] += [off.sum(), off[begin].sum(), ((1 - left) * right * linked).sum() - expected[0, 1],
                               (left * (1 - right) * linked).sum() - expected[1, 0], (left * right * linked).sum() - expected[1, 1]]
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["gradient"])


def fit_weights(train: DataFrame, chosen: dict[str, bool], iterations: int = ITERATIONS) -> tuple[dict[str, float], np.ndarray]:
    """(weight of each feature, the other weights), by adaptive gradient ascent on the conditional likelihood with a quadratic penalty."""
    names = sorted(chosen)
    shared = train.sparkSession.sparkContext.broadcast(({f: k for k, f in enumerate(names)}, {f for f in names if chosen[f]}))
    sequences = stored(train.select("text", "toxic").mapInArrow(
        lambda it: _sequences(it, shared), "n long, at array<int>, feature array<int>, gold array<int>"), "sequences")
    weights, squares = np.zeros(len(names) + OTHERS), np.full(len(names) + OTHERS, 1e-9)
    for _ in range(iterations):
        parts = sequences.mapInArrow(lambda it, w=weights: _gradient(it, w), "gradient array<double>").collect()    # one row a task
        gradient = np.sum([r.gradient for r in parts], axis=0) - SHRINK * weights
        squares += gradient ** 2
        weights = weights + RATE * gradient / np.sqrt(squares)
    return dict(zip(names, weights[:len(names)].tolist(), strict=True)), weights[len(names):]


# --- scoring ----------------------------------------------------------------------------------------------------------------------------

class _Evidence(dict):
    """Log odds by word, without bias."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        found = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return found


def _spans(text: str, flagged: np.ndarray, chance: np.ndarray) -> list[dict]:
    """Runs of flagged words as offsets of characters."""
    out, last = [], -2
    wanted = dict(zip(flagged.tolist(), chance.tolist(), strict=True))
    end = int(flagged[-1])
    for k, m in enumerate(_word.finditer(text)):
        if k in wanted:
            if k == last + 1:
                out[-1][1:] = [m.end(), [*out[-1][2], wanted[k]]]
            else:
                out.append([m.start(), m.end(), [wanted[k]]])
            last = k
        if k == end:
            break
    return [{"start": a, "end": b, "score": sum(p) / len(p)} for a, b, p in out]


def tag(texts: list[str | None], evidence: dict[str, float], others: np.ndarray) -> list[tuple[float, float, list[dict]]]:
    """(largest log odds, expected tagged words, spans) of every text; the log odds are cut at EDGE, -EDGE without words."""
    words = [_word.findall(t) if t else [] for t in texts]
    size = np.array([len(w) for w in words], dtype=np.int64)
    begin = np.cumsum(size) - size
    x = np.fromiter((evidence[w] for ws in words for w in ws), dtype=np.float64, count=int(size.sum()))
    starts = np.zeros(len(x), dtype=bool)
    starts[begin[size > 0]] = True
    chance, _ = marginals(x, starts, others)
    logit = np.clip(np.log(np.maximum(chance, 1e-12)) - np.log(np.maximum(1 - chance, 1e-12)), -EDGE, EDGE)
    most = np.full(len(texts), -EDGE)
    if len(x):
        most[size > 0] = np.maximum.reduceat(logit, begin[size > 0])
    flagged = np.flatnonzero(chance >= SPAN)
    owner = np.searchsorted(begin + size, flagged, side="right")
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for k, t in enumerate(texts):
        here = flagged[cuts[k]:cuts[k + 1]]
        out.append((float(most[k]), float(chance[here].sum()), _spans(t, here - begin[k], chance[here]) if len(here) else []))
    return out


def _tag_batches(batches: Iterator[pa.RecordBatch], text: str, field, curve: np.ndarray | None, names: list[str]) -> Iterator[pa.RecordBatch]:
    weights, others = field.value
    evidence = claim(_Evidence(weights))
    for batch in by_volume(batches, text, TEXT_PER_BATCH):
        if len(evidence) > CACHED_WORDS:
            evidence.clear()
        found = tag(batch.column(batch.schema.get_field_index(text)).to_pylist(), evidence, others)
        inputs = np.array([f[:2] for f in found]).reshape(-1, 2)
        if curve is None:
            new = [pa.array(inputs[:, 0]), pa.array(inputs[:, 1])]
        else:
            score = _curve(inputs, curve)
            new = [pa.array(score), pa.array((score >= 0.5).astype(np.int32)),
                   pa.array([f[2] for f in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *names])


def _inputs(found: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(found)), found[:, 0], np.log1p(found[:, 1])])


def _curve(found: np.ndarray, curve: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(_inputs(found) @ curve, -30, 30)))


def fit_curve(found: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression of the label on (1, largest log odds, log of one plus expected tagged words), by Newton steps with a small penalty."""
    x, w = _inputs(found), np.zeros(3)
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        penalty = np.array([1e-4, 1e-2, 1e-2])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (toxic - p) - penalty * w)
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return w


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS):
    """(feature weights, other weights, curve) from the labelled rows that are not held out."""
    train = training_texts(df, labels, id_col, text, fit_rows)
    n, n_toxic = train.agg(F.count(F.lit(1)), F.count_if("toxic")).first()
    if not n_toxic or n == n_toxic:
        share = (n_toxic + 0.5) / (n + 1) if n else 0.0
        return {}, np.array([-EDGE, 0.0, 0.0, 0.0, 0.0]), np.array([math.log(share / (1 - share)) if share else -30.0, 0.0, 0.0])
    weights, others = fit_weights(train, choose_features(train, n, n_toxic))
    field = df.sparkSession.sparkContext.broadcast((weights, others))
    rows = train.mapInArrow(lambda it: _tag_batches(it, "text", field, None, ["most", "expected"]),
                            "text string, toxic boolean, most double, expected double").select("most", "expected", "toxic").collect()   # fit_rows at most
    found = np.array([(r.most, r.expected) for r in rows])
    return weights, others, fit_curve(found, np.array([float(r.toxic) for r in rows]))


def score(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``df`` with score, predicted and spans (offsets of characters, under fresh names where ``df`` has them)."""
    weights, others, curve = fit(df, labels, id_col, text, fit_rows)
    field = df.sparkSession.sparkContext.broadcast((weights, others))
    plain, names = df, []
    for n in ("score", "predicted", "spans"):
        names.append(fresh(plain, n))
        plain = plain.withColumn(names[-1], F.lit(None))
    kinds = T._parse_datatype_string(f"a double, b int, c {SPANS}").fields
    schema = T.StructType([*df.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, kinds, strict=True))])
    return df.mapInArrow(lambda it: _tag_batches(it, text, field, curve, names), schema)


@query("op13_toxicity")
def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, verdict and number of offending spans of every document."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return score(docs, labels).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", F.size("spans").cast("long").alias("n_spans"))
