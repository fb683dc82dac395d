"""Operator 6: quality rules with risk-controlled thresholds.

Every whole text is counted once (words, symbols, repeated lines, repeated 5-word windows, capitals, marks). A fixed base rule rejects
very short and very repetitive texts. Above it, each rule rejects texts whose ratio exceeds a cutoff, and the cutoffs are chosen per stratum
(language) so that good text is rejected rarely, with a guarantee:

* one half of the labelled rows proposes a cutoff per rule and stratum: of those that reject at most RISK divided by the number of rules of its good rows,
  the loosest that separates bad from good best;
* on the other half, the rules of a stratum are tested together, as one rejection: all cutoffs are loosened by the same number of bins, and that
  number falls from the largest on. It passes if the false rejections k among n good rows make a risk above ``RISK`` implausible: the exact binomial
  tail P(X <= k) is at most ``ERROR`` divided by the number of strata tested (Bonferroni). Testing stops at the first failure (fixed sequence) or at the
  proposals; the last that passed holds.

So with confidence 1 - ERROR, at most RISK of the good text of every stratum is rejected by the rules together. Where the
labels are too few for that (at four strata: below 86 good held-out rows), a stratum has no cutoff and its rules reject nothing.

Scale: the texts are read once and not shuffled; labels meet a few counts per document; histograms (a number per stratum, rule and bin) are summed and judged a stratum a
group, in Spark, for any number of strata; the driver gets their number.

Edge cases: a null or empty text has no words and fails the base rule; a null language is a stratum; rows with a null label are not
used, several labels of an id count as the worst; repeated rows stay; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_volume, claim, query, stored, table
from .jaccard import _hashes, window_hashes

TEXT_PER_BATCH = 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS, MOST_REPEATED = 10, 20          # base rule: words; repeated words in a hundred
RISK, ERROR = 0.05, 0.05
#: rules: the ratio of two counts
RATIOS = {"symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"),
          "capitals": ("n_upper", "word_chars"), "marks": ("n_marks", "n_words")}
PER_DECADE, DECADES_BELOW, TOP_BIN = 20, 4, 140      # bins from 1e-4 to 1e3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()                       # ASCII white space
    seen, lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            dup += line in seen
            seen.add(line)
    h = window_hashes(words, WINDOW)
    covered = np.zeros(len(words), dtype=bool)
    if len(h):
        _, place, times = np.unique(h, return_inverse=True, return_counts=True)
        twice = times[place] > 1
        if twice.any():
            for j in range(WINDOW):
                covered[j:j + len(h)] |= twice
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, int(covered.sum()), lines, upper,
            text.count("!"))


def _count_batches(batches) -> Iterator[pa.RecordBatch]:
    claim(_hashes)
    for b in by_volume(batches, "text", TEXT_PER_BATCH):
        counts = np.array([text_counts(t) for t in b.column(0).to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), *map(pa.array, counts.T)], names=["id", "stratum", *COUNTS])


def ratio_bin(rule: str) -> Column:
    """The bin of a rule's ratio: 0 for none, then logarithmic."""
    over, under = RATIOS[rule]
    ratio = F.col(over) / F.greatest(F.col(under), F.lit(1))
    place = F.floor((F.log10(ratio) + DECADES_BELOW) * PER_DECADE) + 1
    return F.when(ratio > 0, F.least(F.greatest(place, F.lit(1)), F.lit(TOP_BIN))).otherwise(0).cast("int")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly."""
    if k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def _above(counts: np.ndarray) -> np.ndarray:
    """Rows in higher bins, for each bin as cutoff."""
    return counts[::-1].cumsum()[::-1] - counts


def propose(good: np.ndarray, bad: np.ndarray, most_good: float = 1.0) -> int | None:
    """The loosest bin that separates bad from good best and rejects at most ``most_good`` of the good rows, or None."""
    if not bad.sum():
        return None
    rejected = _above(good) / max(1, good.sum())
    gain = np.where(rejected <= most_good, _above(bad) / bad.sum() - 5 * rejected, 0.0)
    return int(np.nonzero(gain == gain.max())[0].max()) if gain.max() > 0 else None


def settle(good_hold: np.ndarray, proposal: int, risk: float, error: float) -> int | None:
    """The last cutoff, from the loosest bin down to the proposal, before the first that fails its test, or None."""
    held, n, best = _above(good_hold), int(good_hold.sum()), None
    if not n:
        return None
    for cut in range(len(held) - 1, proposal - 1, -1):
        if (best is None or held[cut] != held[cut + 1]) and binomial_tail(int(held[cut]), n, risk) > error:
            break
        best = cut
    return best


def choose_cutoff(good_tune: np.ndarray, bad_tune: np.ndarray, good_hold: np.ndarray, risk: float, error: float) -> int | None:
    """The bin above which a single rule rejects, or None; arguments: rows per bin, the risk allowed and the level of the test."""
    proposal = propose(good_tune, bad_tune)
    return None if proposal is None else settle(good_hold, proposal, risk, error)


def count_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """(id, stratum, COUNTS) of every row."""
    rows = df.select(F.col(text).alias("text"), F.col(id_col).cast("long").alias("id"), F.col(stratum).cast("string").alias("stratum"))
    return rows.mapInArrow(_count_batches, "id bigint, stratum string, " + ", ".join(f"{c} bigint" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _proposals(hist: pd.DataFrame, risk: float) -> pd.DataFrame:
    """The proposed cutoff bins of one stratum, from its rows per rule and bin; no row if there is none."""
    found = {}
    for rule, part in hist.groupby("rule"):
        good, bad = np.zeros(TOP_BIN + 1, dtype=np.int64), np.zeros(TOP_BIN + 1, dtype=np.int64)
        good[part["bin"]], bad[part["bin"]] = part["good"], part["bad"]
        found[rule] = propose(good, bad, risk / len(RATIOS))
    row = [hist["stratum"].iloc[0], *(found.get(r) for r in RATIOS)]
    return pd.DataFrame([row] if any(v is not None for v in row[1:]) else [], columns=["cut_stratum", *(f"cut_{r}" for r in RATIOS)], dtype=object)


def _loosened(hist: pd.DataFrame, risk: float, error: float) -> pd.DataFrame:
    """By how many bins the proposals of one stratum are loosened together, from its good held-out rows per excess; no row if no number passes."""
    held = np.zeros(TOP_BIN + 1, dtype=np.int64)
    held[hist["excess"]] = hist["rows"]
    by = settle(held, 0, risk, error)
    return pd.DataFrame([] if by is None else [(hist["held_stratum"].iloc[0], by)], columns=["held_stratum", "by"], dtype=object)


def cutoffs(counted: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(cut_stratum, cut_<rule>...): the cutoff bins of the strata that have any, from all labelled rows that the base rule passes."""
    one = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("label_id"))
           .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic")))
    known = counted.where(~base_failed()).join(one, F.col("id") == F.col("label_id")).select(
        "stratum", (F.pmod(F.xxhash64("id", F.lit(6)), F.lit(2)) == 0).alias("tune"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"), (F.col("quality") == 0).alias("bad"),
        *[ratio_bin(r).alias(f"bin_{r}") for r in RATIOS])
    known = stored(known, "rule-bins")
    bins = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"bin_{r}").alias("bin")) for r in RATIOS])).alias("b")
    hists = (known.where("tune").select("stratum", "good", "bad", bins).groupBy("stratum", F.col("b.rule").alias("rule"), F.col("b.bin").alias("bin"))
             .agg(F.count_if("good").alias("good"), F.count_if("bad").alias("bad")))
    kind = "cut_stratum string, " + ", ".join(f"cut_{r} int" for r in RATIOS)
    proposed = stored(hists.groupBy("stratum").applyInPandas(lambda h: _proposals(h, risk), kind), "rule-proposals")
    tested = max(1, proposed.count())
    # how far the rule that rejects a row first lies above its proposal; 0: no rule rejects it
    excess = F.greatest(F.lit(0), *[F.col(f"bin_{r}") - F.col(f"cut_{r}") for r in RATIOS])
    held = (known.where("good AND NOT tune").join(proposed, F.col("stratum").eqNullSafe(F.col("cut_stratum")))
            .groupBy(F.col("stratum").alias("held_stratum"), excess.alias("excess")).agg(F.count(F.lit(1)).alias("rows")))
    loose = held.groupBy("held_stratum").applyInPandas(lambda h: _loosened(h, risk, error / tested), "held_stratum string, by int")
    return proposed.join(loose, F.col("cut_stratum").eqNullSafe(F.col("held_stratum"))).select(
        "cut_stratum", *[(F.col(f"cut_{r}") + F.col("by")).alias(f"cut_{r}") for r in RATIOS])


def apply_rules(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
                risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per row: id, stratum, COUNTS, ``base_failed``, ``failed_rules`` and ``kept``."""
    counted = stored(count_texts(df, id_col, text, stratum), "text-counts")
    cut = stored(cutoffs(counted, labels, risk, error), "rule-cutoffs")
    judged = counted.join(cut, F.col("stratum").eqNullSafe(F.col("cut_stratum")), "left")
    failed = F.filter(F.array(*[F.when(ratio_bin(r) > F.col(f"cut_{r}"), F.lit(r)) for r in RATIOS]), lambda r: r.isNotNull())
    return judged.select("id", "stratum", *COUNTS, base_failed().alias("base_failed"), failed.alias("failed_rules")).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).withColumnRenamed("id", id_col)


@query("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of every document."""
    judged = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                         F.array_join("failed_rules", ",").alias("failed_rules"))
