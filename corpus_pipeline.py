"""Documents to training data: five stages, each one operator of :mod:`quarry.llm` over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; :func:`run` writes each result to the shared folder as Parquet
and reads it back as the next stage's documents. All stages but the last return the columns of ``documents``.

* ``quality``: importance resampling against the labels; documents that are not drawn go.
* ``lines``: boilerplate lines go from all documents but their first; a document left without a word goes.
* ``near_duplicates``: of each group of near duplicates (five-word shingles, Jaccard 0.8), the smallest id stays.
* ``mixing``: documents get the rates that bring low-quality and toxic text down to its share, wholly plain ones 1; each stands there as often
  as its copies.
* ``encode``: ids of every whole text, decoded again as a check, one row per document and copy.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, jaccard, lines, mixing, resampling
from quarry.llm.common import bound_batches, fresh, stored, table
from quarry.session import ship_package

#: what is left of junk after the quality stage may stay at one part in a hundred; toxic text has no share
MIX = {"plain": 0.99, "junk": 0.01, "toxic": 0.0}
HAS_WORD = r"[^\x20\x09-\x0D]"


def _stage(fn):
    """The stage with the package sent to the executors and batches bounded first, so that it can be called on its own."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        bound_batches(spark)
        return fn(spark, docs, sf_dir)
    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the documents drawn by importance resampling; a text without words is not drawn."""
    kept, weight = fresh(docs, "kept"), fresh(docs, "log_weight")
    drawn = resampling.resample(docs, table(spark, sf_dir, "labels"), kept=kept, weight=weight)
    return drawn.where(F.col(kept)).select(docs.columns)


@_stage
def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: texts without cross-site boilerplate; documents that lose all their words go."""
    removed = fresh(docs, "n_removed")
    cut = lines.dedup_lines(docs, removed=removed).where((F.col(removed) == 0) | F.col("text").rlike(HAS_WORD))
    n_chars = F.when(F.col(removed) > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return cut.withColumn("n_chars", n_chars).select(docs.columns)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group, its smallest id. Of several rows with one id the first in
    order of their values stays; rows without id stay."""
    found = stored(jaccard.near_components(docs, rule=jaccard.Rule(5, 80, 100)).select("doc_id", "component_id"), "groups")
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    again = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    rest = docs.join(gone.hint("merge"), "doc_id", "left_anti")      # one plan, and one shuffle of the texts, at every size
    if again.isEmpty():
        return rest.select(docs.columns)
    others = [c for c in docs.columns if c != "doc_id"]
    repeated = rest.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("row")).select("doc_id", "row.*")
    return rest.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(repeated.select(docs.columns))


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every document as often as its rate says."""
    rated = mixing.mix(docs, table(spark, sf_dir, "labels"), MIX, plain_once=True)
    n_copies = F.col(rated.columns[-1]).cast("int")
    return rated.where(n_copies > 0).withColumn(fresh(rated, "copy"), F.explode(F.sequence(F.lit(1), n_copies))).select(docs.columns)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: ids and their digests."""
    path = public_tokenizers.path(bpe.MULTI_50K)
    decoded = bpe.round_trip(docs.select("doc_id", "text"), "text", path)
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("lines", clean_lines), ("near_duplicates", near_duplicates), ("mixing", mixed), ("encode", encode)]

#: resampling, mixing and byte-pair merges have no SQL form; tests hold every stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return stored(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
