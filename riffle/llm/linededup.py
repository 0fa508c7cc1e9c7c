"""Cross-site boilerplate: lines on many sites, counted by HyperLogLog sketches per line hash.

Only DataFrame and SQL functions.  Sketches of one line merge by aggregation, so a line that a third of
all documents share is reduced before the shuffle.  Sketches decide clear cases; lines whose
estimate lies near the threshold get an exact distinct count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import materialize, table
from riffle.llm.registry import query

MIN_SITES = 5
LG_SKETCH = 12
#: A text that would lose more than this share of its characters is a copy, not a page with boilerplate.
MAX_SHARE = 0.5


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _printing(line: Column) -> Column:
    return F.translate(line, " \t\r", "") != ""


def _hash(line: Column) -> Column:
    return F.xxhash64(line)


def boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, text: str = "text", site: str = "source") -> DataFrame:
    """(line) hashes of the lines that stand on at least ``min_sites`` distinct sites.

    Blank lines (spaces, tabs, carriage returns) are never boilerplate; a null site is no site.  The result equals
    the exact count unless an estimate is off by more than four standard errors.
    """
    hashes = F.transform(F.filter(_lines(F.col(text)), _printing), _hash)
    seen = docs.where(F.col(site).isNotNull()).select(F.col(site).cast("string").alias("site"), F.explode(F.array_distinct(hashes)).alias("line"))
    counted = seen.groupBy("line").agg(F.hll_sketch_agg("site", F.lit(LG_SKETCH)).alias("sketch"), F.count(F.lit(1)).alias("texts"))
    margin = max(1, math.ceil(4 * 1.04 / math.sqrt(1 << LG_SKETCH) * min_sites))
    estimate = F.hll_sketch_estimate("sketch")
    spread = materialize(counted.where(F.col("texts") >= min_sites).select("line", estimate.alias("sites")).where(F.col("sites") >= min_sites - margin))
    near = spread.where(F.col("sites") <= min_sites + margin).select("line")
    exact = seen.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count(F.lit(1)).alias("sites"))
    sure = spread.where(F.col("sites") > min_sites + margin)
    return materialize(sure.select("line").unionByName(exact.where(F.col("sites") >= min_sites).select("line")))


def strip_lines(docs: DataFrame, lines: DataFrame, max_share: float = MAX_SHARE, text: str = "text") -> DataFrame:
    """``docs`` with the named lines taken out of the text, and n_lines, n_cross_site, n_removed.

    A text that would lose more than ``max_share`` of its characters stays as it is (n_removed 0): it
    is a copy or near copy of others as a whole, which near-duplicate removal handles.  Null texts stay null with 0
    lines; columns named like the new ones are replaced; repeated rows are treated alike.
    """
    new = ["n_lines", "n_cross_site", "n_removed", "_text_hash", "_cut", "_short"]
    docs = docs.drop(*new).withColumn("_text_hash", F.xxhash64(text))
    per_text = docs.where(F.col(text).isNotNull()).select(
        "_text_hash", F.explode(F.array_distinct(F.transform(F.filter(_lines(F.col(text)), _printing), _hash))).alias("line")
    )
    # copies of a text count once, and each text gets the list of its own lines only
    cut = per_text.join(lines, "line").groupBy("_text_hash").agg(F.collect_set("line").alias("_cut"))
    joined = docs.join(cut, "_text_hash", "left")
    whole, none = _lines(F.col(text)), F.array().cast("array<bigint>")
    stays = lambda line: ~(F.array_contains(F.coalesce("_cut", none), F.xxhash64(line)) & _printing(line))
    joined = joined.withColumn("_short", F.when(F.col("_cut").isNotNull(), F.filter(whole, stays)))
    joined = joined.select(
        *docs.columns, F.coalesce(F.size(whole), F.lit(0)).cast("long").alias("_lines"),
        F.coalesce(F.size(whole) - F.size("_short"), F.lit(0)).cast("long").alias("n_cross_site"),
        F.array_join("_short", "\n").alias("_clean"),
    )
    removes = F.col("_clean").isNotNull() & (F.length(text) - F.length("_clean") <= max_share * F.length(text))
    return joined.select(
        *(F.when(removes, F.col("_clean")).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in docs.columns if c != "_text_hash"),
        F.when(F.col(text).isNull(), 0).otherwise(F.col("_lines")).cast("long").alias("n_lines"), "n_cross_site",
        F.when(removes, F.col("n_cross_site")).otherwise(0).cast("long").alias("n_removed"),
    )


SQL = """
WITH line AS (
  SELECT doc_id, source, generate_subscripts(string_split(text, chr(10)), 1) AS place, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL
), cross_site AS (
  SELECT line FROM line WHERE translate(line, ' ' || chr(9) || chr(13), '') <> '' GROUP BY line HAVING count(DISTINCT source) >= 5
), clean AS (
  SELECT doc_id, count(*) AS n_lines, count(c.line) AS n_cross_site,
         coalesce(string_agg(l.line, chr(10) ORDER BY place) FILTER (WHERE c.line IS NULL), '') AS clean
  FROM line l LEFT JOIN cross_site c ON l.line = c.line GROUP BY doc_id
), decided AS (
  SELECT d.doc_id, d.text, n_lines, n_cross_site, clean,
         n_cross_site > 0 AND length(d.text) - length(clean) <= 0.5 * length(d.text) AS removes
  FROM documents d LEFT JOIN clean USING (doc_id)
)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_cross_site, 0)::BIGINT AS n_cross_site,
       CASE WHEN removes THEN n_cross_site ELSE 0 END::BIGINT AS n_removed,
       sha256(CASE WHEN removes THEN clean ELSE text END) AS text_sha256
FROM decided
"""


@query("op1_line_dedup", SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its lines counted and its text without cross-site boilerplate, as a digest."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = strip_lines(docs, boilerplate(docs))
    return out.select("doc_id", "n_lines", "n_cross_site", "n_removed", F.sha2("text", 256).alias("text_sha256"))
