"""Operator 8: quality classifier by importance resampling.

Two generative models over hashed n-grams (:mod:`quarry.llm.ngrams`), each feature present with its own probability: one of
target text (labelled: good quality, not toxic), one of raw text (all documents). A text's log importance weight is the
log ratio of its probability under the two. Only features whose two rates differ beyond chance and by a
factor count; the rest have ratio one. The features are tokens and all pairs of adjacent tokens; pairs weigh half
(:func:`quarry.llm.ngrams.weigh_pairs`). Documents are then drawn without replacement by Gumbel top-k: the k largest
of log weight / temperature + Gumbel noise, the noise a hash of id and text. ``k`` is the number of documents that weigh as much
as all but ``miss`` of the held-out target rows, so the draw keeps target-like text and leaves the rest.

Counts cover all documents; the target model is fitted on a bounded, documented number of labelled rows. What goes to the
driver is two count arrays of fixed length and per-pass histograms of fixed length; what is broadcast is one weight array of
fixed length and the bounded label sample. The corpus is read twice, nothing of it is shuffled.

Edge cases: a null text or one without words has a null weight and is never drawn; without target labels
every weight is equal and all texts with words are drawn; repeated rows (same id and text) have equal keys and are
drawn together (ties at the cut are all drawn); a null id is an id like others; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .common import by_volume, fresh, query, stored, table

FIT_ROWS = 50_000        # labelled rows used at most
SIGNIFICANCE = 4.5       # standard errors
LEAST_EXPECTED = 4.0     # target rows with a feature that chance would give
LEAST_RATIO = 0.5        # of the log rates
TEMPERATURE = 0.25
MISS = 0.01
SCALE = 1 << 20          # weights are whole multiples of 1/SCALE, so that sums do not depend on the order
BINS = 4096


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ngrams.new_task()
    counts = np.zeros(2 * ngrams.BUCKETS, dtype=np.int32)
    raw, target = np.split(counts, 2)
    for batch in by_volume(batches, "text", ngrams.TEXT_PER_BATCH):
        found, bounds, _ = ngrams.features_of(batch.column(0))
        np.add.at(raw, found, 1)
        np.add.at(target, found[np.array(batch.column(1).to_pylist(), dtype=bool).repeat(np.diff(bounds))], 1)
    yield from ngrams.count_rows(counts)


def fit_weights(raw: np.ndarray, target: np.ndarray, n_raw: int, n_target: int) -> tuple[np.ndarray, int]:
    """(weight of each present feature, weight of a text without any), as multiples of 1/SCALE."""
    if not n_target or not n_raw:
        return np.zeros(len(raw), dtype=np.int64), 0
    share = min(n_target / n_raw, 1.0)
    expected = raw * share
    z = (target - expected) / np.sqrt(np.maximum(expected * max(1 - share, 1e-9), 1e-9))
    p_target, p_raw = (target + 0.5) / (n_target + 1), (raw + 0.5 / share) / (n_raw + 1 / share)
    ratio = np.log(p_target / p_raw)
    chosen = (np.abs(z) >= SIGNIFICANCE) & (expected >= LEAST_EXPECTED) & (np.abs(ratio) >= LEAST_RATIO)
    absent = np.log1p(-np.minimum(p_target[chosen], 0.999)) - np.log1p(-np.minimum(p_raw[chosen], 0.999))
    weights = np.zeros(len(raw))
    weights[chosen] = ratio[chosen] - absent
    return np.rint(ngrams.weigh_pairs(weights) * SCALE).astype(np.int64), int(np.rint(absent.sum() * SCALE))


def _weigh_batches(batches, text: str, out: str, weights, base: int) -> Iterator[pa.RecordBatch]:
    ngrams.new_task()
    w = weights.value
    for batch in by_volume(batches, text, ngrams.TEXT_PER_BATCH):
        found, bounds, n = ngrams.features_of(batch.column(batch.schema.get_field_index(text)))
        values = (base + ngrams.sums(w[found].astype(np.int64), bounds)) / SCALE
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64(), mask=n == 0)],
                                         names=[*batch.schema.names, out])


def log_weights(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
                out: str = "log_weight", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``df`` with its log importance weights in ``out``, which it must not have."""
    sample = ngrams.label_sample(labels, fit_rows)
    known = df.select(F.col(text).alias("text"), F.col(id_col).alias("own_id")).join(
        F.broadcast(sample), F.col("own_id") == F.col("label_id"), "left")   # at most fit_rows rows
    is_target = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0) & ~F.col("holdout"), F.lit(False))
    rows = known.select("text", is_target.alias("is_target"))
    raw, target = ngrams.summed(rows.mapInArrow(_count_batches, ngrams.COUNT_SCHEMA), 2)
    n_raw, n_target = rows.agg(F.count(F.lit(1)), F.count_if("is_target")).first()
    weights, base = fit_weights(raw, target, n_raw, n_target)
    shared = df.sparkSession.sparkContext.broadcast(weights.astype(np.int32))     # far below 2**31: logarithms times SCALE
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    return df.mapInArrow(lambda it: _weigh_batches(it, text, out, shared, base), schema)


def kth_largest(df: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of a column without nulls and NaN; each pass collects BINS counts, the last at most BINS values."""
    lo, hi, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if not n or k < 1:
        return None
    if k >= n or lo == hi:
        return lo
    while True:
        here = df.where(F.col(key).between(lo, hi))
        place = F.least(F.floor((F.col(key) - lo) / ((hi - lo) / BINS)), F.lit(BINS - 1)).cast("int")
        bins = {r.place: r for r in here.groupBy(place.alias("place")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}
        for b in sorted(bins, reverse=True):
            if k <= bins[b].n:
                break
            k -= bins[b].n
        lo, hi = bins[b].lo, bins[b].hi
        if lo == hi:
            return lo
        if bins[b].n <= BINS:
            values = [r[0] for r in df.where(F.col(key).between(lo, hi)).select(key).collect()]
            return sorted(values, reverse=True)[k - 1]


def gumbel(*columns) -> F.Column:
    """Standard Gumbel noise from a hash of the columns: the same for equal rows, in any partitioning."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*columns, F.lit(8)), 11) + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def resample(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
             kept: str = "kept", weight: str = "log_weight", temperature: float = TEMPERATURE, miss: float = MISS,
             fit_rows: int = FIT_ROWS, keep_text: bool = True) -> DataFrame:
    """``df`` with ``weight`` and ``kept`` (drawn), under fresh names where ``df`` has them; the texts are left out unless ``keep_text``."""
    weight, kept, key = fresh(df, weight), fresh(df, kept), fresh(df, "draw_key")
    weighed = log_weights(df, labels, id_col, text, weight, fit_rows)
    keyed = weighed.withColumn(key, F.col(weight) / temperature + gumbel(F.col(id_col), F.col(text)))
    keyed = stored(keyed if keep_text else keyed.drop(text), "weighed")
    sample = ngrams.label_sample(labels, fit_rows).where("quality = 1 AND toxic = 0 AND holdout").select("label_id")
    least = keyed.select(id_col, weight).join(F.broadcast(sample), F.col(id_col) == F.col("label_id")).agg(
        F.percentile(weight, F.lit(miss))).first()[0]     # of the bounded sample
    drawable = keyed.where(F.col(key).isNotNull()).select(key, weight)
    k = drawable.count() if least is None else drawable.where(F.col(weight) >= least).count()
    cut = kth_largest(drawable, key, k)
    return keyed.withColumn(
        kept, F.coalesce(F.col(key) >= F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)).drop(key)


@query("op8_quality_resampling")
def op8_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log importance weight of every document and whether it is drawn."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    return resample(docs, labels, keep_text=False).select("doc_id", "log_weight", "kept")
