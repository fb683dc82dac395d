"""Operator 3: line dedup by distinct-site spread. DataFrame functions only.

A line's spread is the number of distinct sites it stands on. One HyperLogLog sketch per line hash,
merged by partial aggregation, estimates it; lines whose estimate lies within three standard errors
of the threshold get an exact distinct count. A line on as many sites as its length asks for (``SITES``: a long line
that repeats on a few sites is no accident, a short one may be) is
boilerplate: it stays at its first place (smallest id, then line number) and goes everywhere else.

Scale: the texts are read twice and shuffled once (to meet their line numbers to drop, and not at
all while those fit Spark's broadcast limit); what the statistics shuffle is
a fixed few bytes a line. A hot line is aggregated before its shuffle, and meets its verdict in
a sort-merge join that AQE may split.

Edge cases: lines are trimmed of ASCII white space before comparison; lines without a word are never dropped; a null text has no lines and stays null; a null site counts
as no site; rows with the same id and text count once and get the same result; a null id is
ordered first. Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, query, stored, table

SITES = ((40, 5), (12, 10), (1, 15))     # (least characters of a trimmed line, sites from which it is boilerplate)
LG_K = 10                         # 2^10 registers: 3.3 % standard error once the sketch is dense
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
BLANKS = " \t\n\x0b\x0c\r"


def sites_needed(line: Column, sites: Sequence[tuple[int, int]] = SITES) -> Column:
    """The sites from which a trimmed line is boilerplate, by its length; null for one shorter than all of ``sites``."""
    rules = sorted(sites, reverse=True)
    found = F.when(F.length(line) >= rules[0][0], F.lit(rules[0][1]))
    for chars, n in rules[1:]:
        found = found.when(F.length(line) >= chars, F.lit(n))
    return found


def line_places(df: DataFrame, id_col: str, text: str, site: str, sites: Sequence[tuple[int, int]] = SITES) -> DataFrame:
    """One row per line that can be boilerplate: (id, text_hash, site, line_no, line, need)."""
    return (df.where(F.col(text).isNotNull())
            .select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), F.col(site).alias("site"),
                    F.posexplode(F.split(text, "\n")).alias("line_no", "content"))
            .withColumn("content", F.btrim("content", F.lit(BLANKS)))
            .select("id", "text_hash", "site", "line_no", F.xxhash64("content").alias("line"),
                    sites_needed(F.col("content"), sites).cast("int").alias("need"))
            .where("need IS NOT NULL"))


def boilerplate(places: DataFrame) -> DataFrame:
    """The lines on at least as many sites as they need, each with its first place."""
    spread = places.groupBy("line", "need").agg(
        F.hll_sketch_agg("site", F.lit(LG_K)).alias("sketch"),
        F.min(F.struct("id", "text_hash", "line_no")).alias("first"))
    lines = stored(spread.select("line", "need", "first", F.hll_sketch_estimate("sketch").alias("sites"))
                   .where(F.col("sites") >= F.col("need") * (1 - 3 * STANDARD_ERROR)), "line-spread")
    sure = F.col("sites") > F.col("need") * (1 + 3 * STANDARD_ERROR)
    near = lines.where(~sure)
    exact = (places.join(near.select("line"), "line", "left_semi")
             .select("line", "need", "site").distinct()
             .groupBy("line", "need").agg(F.count("site").alias("exact_sites"))
             .where(F.col("exact_sites") >= F.col("need")))
    return (lines.where(sure).select("line", "first")
            .unionByName(near.join(exact, "line", "left_semi").select("line", "first")))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source",
                min_sites: int | None = None, sites: Sequence[tuple[int, int]] = SITES,
                removed: str = "n_removed") -> DataFrame:
    """``df`` with boilerplate lines cut from ``text``, and ``removed``, the number of lines cut. ``min_sites``: one threshold for all lengths."""
    places = stored(line_places(df, id_col, text, site, sites if min_sites is None else ((1, min_sites),)), "line-places")
    bad = boilerplate(places)
    drop = (places.drop("need").join(bad, "line")
            .where(F.struct("id", "text_hash", "line_no") != F.col("first"))
            .groupBy("id", "text_hash").agg(F.collect_set("line_no").alias("drop")))
    names = {c: fresh(df, c) for c in ("id", "text_hash", "drop")}
    drop = drop.select(*[F.col(c).alias(n) for c, n in names.items()])
    hashed = fresh(df, "own_text_hash")
    base = df.drop(removed) if removed in df.columns else df
    joined = base.withColumn(hashed, F.xxhash64(text)).join(
        drop, F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.col(hashed) == F.col(names["text_hash"])), "left")
    cut = F.col(names["drop"])
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), cut)
    clean = F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")
    return joined.select(
        *[F.when(cut.isNull(), F.col(text)).otherwise(clean).alias(c) if c == text else F.col(c) for c in base.columns],
        F.coalesce(F.size(F.coalesce(cut, F.array().cast("array<int>"))), F.lit(0)).cast("long").alias(removed))


OP3_SQL = """
WITH lines AS (
    SELECT doc_id, source, k AS line_no, content, trim(content, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
    FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS content,
                 generate_subscripts(string_split(text, chr(10)), 1) AS k FROM documents)
), bad AS (
    SELECT line, min((doc_id, line_no)) AS first FROM lines
    WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= CASE WHEN length(line) >= 40 THEN 5 WHEN length(line) >= 12 THEN 10 ELSE 15 END
), marked AS (
    SELECT doc_id, line_no, content, bad.line IS NOT NULL AND (doc_id, line_no) <> bad.first AS gone
    FROM lines LEFT JOIN bad USING (line)
), clean AS (
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           coalesce(string_agg(content, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS clean_text
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(clean_text) AS clean_sha256
FROM documents d LEFT JOIN clean USING (doc_id)
"""


@query("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cross-site boilerplate lines cut, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    docs = docs.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"))
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("clean_sha256"))
