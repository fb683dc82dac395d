"""Operator 5: mixing to target weights by soft membership.

A classifier fitted on the label table gives every document posteriors over the domains ``plain`` (good and not toxic), ``junk`` (low
quality) and ``toxic``; a document belongs to each of them in part. Document rates r >= 0 are then fitted so that the expected
tokens of the domains, E_d = sum(rate * tokens * posterior_d), match the targets in least squares, by projected gradient from rate 1:

    rate <- max(0, rate - posterior . step),   step = G^-1 (E - target),   G = sum(tokens * posterior posterior^T)

(the gradient of the residual weighted by G^-1, in the metric of the tokens, for which the step length 1 is the reciprocal of the largest
curvature), with momentum that starts anew when the weighted loss rises. Every step is a job over the stored posteriors that goes
through the steps so far; the driver holds three numbers. A rate becomes a whole number of copies, its fraction decided by a hash of the document, so
expected copies are the rates.

The classifier is a Bernoulli naive Bayes over hashed n-grams (:mod:`quarry.llm.ngrams`), fitted on at most ``FIT_ROWS`` labelled rows, on the
features that junk or toxic text shows more often than all text, beyond chance, and at least twice as often as plain text (what marks plain
text, its common words, would only measure length). Pairs of tokens count where they are present, and half
(:func:`quarry.llm.ngrams.weigh_pairs`). All documents are scored and mixed; none is shuffled.

Edge cases: a null or empty text has no tokens, the posteriors of a text without features and its rate like any; without labels
everything is plain; a domain that no document has cannot be matched and stays a residual; repeated rows (same id and text) get the same
copies; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .common import by_volume, fresh, query, stored, table

DOMAINS = ("plain", "junk", "toxic")
TARGETS = {"plain": 0.90, "junk": 0.06, "toxic": 0.04}
FIT_ROWS = 20_000
SIGNIFICANCE = 4.5
LEAST_EXPECTED = 3.0
LEAST_RATIO = 2.0        # of a feature's rates in a domain and in plain text
ITERATIONS = 120
PATIENCE, TOLERANCE = 5, 1e-3
LEAST_LOSS = 1e-13       # of all tokens


def _domain() -> Column:
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ngrams.new_task()
    counts = np.zeros(len(DOMAINS) * ngrams.BUCKETS, dtype=np.int32)
    for batch in by_volume(batches, "text", ngrams.TEXT_PER_BATCH):
        found, bounds, _ = ngrams.features_of(batch.column(0))
        domain = np.array(batch.column(1).to_pylist(), dtype=np.int64).repeat(np.diff(bounds))
        np.add.at(counts, domain * ngrams.BUCKETS + found, 1)
    yield from ngrams.count_rows(counts)


def fit_posteriors(counts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(base, weights): log scores of a text without features, and what each present feature adds, per domain.

    ``counts``: rows with a feature, per domain and bucket; ``rows``: labelled rows per domain.
    """
    total = rows.sum()
    weights = np.zeros_like(counts, dtype=np.float64)
    base = np.log((rows + 1e-3) / (total + 3e-3))
    if total:
        every = counts.sum(axis=0)
        chosen = np.zeros(counts.shape[1], dtype=bool)
        rate = (counts + 0.5) / (rows[:, None] + 1.0)
        for d in range(1, len(rows)):
            share = rows[d] / total
            expected = every * share
            z = (counts[d] - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
            chosen |= (z >= SIGNIFICANCE) & (every - expected >= LEAST_EXPECTED) & (rate[d] >= LEAST_RATIO * rate[0])
        p = rate[:, chosen]
        absent = np.log1p(-p)
        absent[:, np.flatnonzero(chosen) >= ngrams.TOKENS] = 0.0    # a text lacks nearly all pairs: that says nothing
        weights[:, chosen] = np.log(p) - absent
        weights[:, chosen] -= weights[0, chosen]                     # beside plain text; unchosen features have ratio one
        base = base + absent.sum(axis=1)
        base -= base[0]
        weights = ngrams.weigh_pairs(weights)
    return base, weights


def _score_batches(batches, text: str, base: np.ndarray, weights, names: list[str]) -> Iterator[pa.RecordBatch]:
    ngrams.new_task()
    w = weights.value.view(np.complex128)[:, 0]      # both domains beside plain text in one number, so that one sum adds up both
    for batch in by_volume(batches, text, ngrams.TEXT_PER_BATCH):
        found, bounds, n = ngrams.features_of(batch.column(batch.schema.get_field_index(text)))
        s = np.tile(base, (batch.num_rows, 1))
        s[:, 1:] += ngrams.sums(w.take(found), bounds).view(np.float64).reshape(-1, len(DOMAINS) - 1)
        e = np.exp(s - s.max(axis=1, keepdims=True))
        p = e / e.sum(axis=1, keepdims=True)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), *map(pa.array, p.T)],
                                         names=[*batch.schema.names, *names])


def posteriors(df: DataFrame, labels: DataFrame, names: list[str], id_col: str = "doc_id", text: str = "text",
               fit_rows: int = FIT_ROWS) -> DataFrame:
    """``df`` with ``names``: its tokens (words) and its posterior for each of DOMAINS."""
    sample = ngrams.label_sample(labels, fit_rows).select("label_id", _domain().alias("domain"))
    known = df.select(F.col(text).alias("text"), F.col(id_col).alias("own_id")).join(
        F.broadcast(sample), F.col("own_id") == F.col("label_id")).select("text", "domain")    # at most fit_rows rows
    counts = np.stack(ngrams.summed(known.mapInArrow(_count_batches, ngrams.COUNT_SCHEMA), len(DOMAINS)))
    seen = {r.domain: r["count"] for r in known.groupBy("domain").count().collect()}
    rows = np.array([seen.get(d, 0) for d in range(len(DOMAINS))], dtype=np.float64)
    base, weights = fit_posteriors(counts, rows)
    shared = df.sparkSession.sparkContext.broadcast(np.ascontiguousarray(weights[1:].T))      # those of plain text are 0
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.LongType()), *[T.StructField(n, T.DoubleType()) for n in names[1:]]])
    return df.mapInArrow(lambda it: _score_batches(it, text, base, shared, names), schema)


def _rate(steps: list[tuple[np.ndarray, float]], shares: list[str]) -> Column:
    """The rate after the steps (step, momentum), from 1, as a column."""
    if not steps:
        return F.lit(1.0)
    taken = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in s]).alias("s"), F.lit(float(m)).alias("m")) for s, m in steps])

    def move(state, step):
        moved = state["now"] + step["m"] * (state["now"] - state["last"]) - sum((step["s"][d] * F.col(n) for d, n in enumerate(shares)), F.lit(0.0))
        return F.struct(F.greatest(F.lit(0.0), moved).alias("now"), state["now"].alias("last"))
    return F.aggregate(taken, F.struct(F.lit(1.0).alias("now"), F.lit(1.0).alias("last")), move, lambda state: state["now"])


def rates(p: np.ndarray, steps: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """The same for an array of posteriors."""
    now = last = np.ones(len(p))
    for s, m in steps:
        now, last = np.maximum(0.0, now + m * (now - last) - p @ s), now
    return now


def _expected(batches: Iterator[pa.RecordBatch], steps: list) -> Iterator[pa.RecordBatch]:
    """The expected tokens of each domain after the steps, over a task's rows (tokens, posteriors)."""
    total = np.zeros(len(DOMAINS))
    for batch in batches:
        tokens, *p = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        p = np.column_stack(p)
        total += (rates(p, steps) * tokens) @ p
    yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["total"])


def fit_rates(scored: DataFrame, tokens: str, shares: list[str], targets: dict[str, float], plain_once: bool = False) -> Column:
    """The rate column that matches the targets over ``scored``.

    The targets are weights; their total is such that the plain domain keeps its expected tokens (or, where it has no weight, all
    tokens are kept). With ``plain_once`` the rates are then divided by that of a wholly plain document: the shares of the domains stay as
    fitted, and plain documents are not repeated to make up for those that go.
    Stops when the last ``PATIENCE`` steps together have lowered the weighted loss by less than ``TOLERANCE`` of it.
    """
    t = F.col(tokens)
    sums = scored.agg(F.sum(t), *[F.sum(t * F.col(a)) for a in shares], *[F.sum(t * F.col(a) * F.col(b)) for a in shares for b in shares]).first()
    sums = np.array([x or 0.0 for x in sums], dtype=np.float64)
    total, now, gram = sums[0], sums[1:1 + len(shares)], sums[1 + len(shares):].reshape(len(shares), len(shares))
    weights = np.array([targets[d] for d in DOMAINS], dtype=np.float64)
    weights /= weights.sum()
    goal = weights * (now[0] / weights[0] if weights[0] > 0 and now[0] > 0 else total)
    inverse = np.linalg.pinv(gram, rcond=1e-9)
    rows = scored.select(t.cast("double"), *shares)

    def loss(expected: np.ndarray) -> float:
        return float((expected - goal) @ inverse @ (expected - goal))
    steps: list[tuple[np.ndarray, float]] = []
    before, speed, losses = now, 1.0, [loss(now)]
    while total and len(steps) < ITERATIONS and losses[-1] > LEAST_LOSS * total:
        if len(losses) > PATIENCE and losses[-1 - PATIENCE] - losses[-1] <= TOLERANCE * losses[-1]:
            break
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        momentum = (speed - 1) / faster
        ahead = now + momentum * (now - before)            # the expectation is linear in the rates
        steps.append((inverse @ (ahead - goal), momentum))
        parts = rows.mapInArrow(lambda it, taken=list(steps): _expected(it, taken), "total array<double>").collect()   # a row a task
        before, now, speed = now, np.sum([r.total for r in parts], axis=0), faster
        losses.append(loss(now))
        if losses[-1] > losses[-2]:
            speed = 1.0                                    # momentum starts anew
    plain = float(rates(np.eye(1, len(DOMAINS)), steps)[0]) if plain_once else 1.0
    return _rate(steps, shares) / F.lit(plain or 1.0)


def mix(df: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, id_col: str = "doc_id", text: str = "text",
        fit_rows: int = FIT_ROWS, keep_text: bool = True, plain_once: bool = False) -> DataFrame:
    """``df`` with n_tokens, p_plain, p_junk, p_toxic, ``rate`` and ``n_copies`` (under fresh names where ``df`` has them)."""
    plain = df
    names = []
    for n in ("n_tokens", *[f"p_{d}" for d in DOMAINS], "rate", "n_copies", "luck"):
        names.append(fresh(plain, n))
        plain = plain.withColumn(names[-1], F.lit(None))
    *scores, rate, copies, luck = names
    scored = posteriors(df, labels, scores, id_col, text, fit_rows).withColumn(luck, F.xxhash64(F.col(id_col), F.col(text), F.lit(55)))
    scored = stored(scored if keep_text else scored.drop(text), "scored")
    uniform = (F.shiftrightunsigned(F.col(luck), 11) + 0.5) / F.lit(float(1 << 53))
    drawn = F.floor(F.col(rate) + uniform)
    return (scored.withColumn(rate, fit_rates(scored, scores[0], scores[1:], targets, plain_once))
            .withColumn(copies, drawn.cast("long")).drop(luck))


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posteriors, rate and copies of every document."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return mix(docs, labels, keep_text=False).select("doc_id", "n_tokens", *[f"p_{d}" for d in DOMAINS], "rate", "n_copies")
