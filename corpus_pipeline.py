"""A training corpus from the documents table: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir).  ``run`` writes each result to the shared folder and
reads it back, so a lost executor never repeats more than one stage.

Defined results of all stages: rows are judged one by one, so of rows with the same id or none each is kept or dropped by its own
text, and equal rows share their fate; null, empty and very long texts are taken whole; an empty table gives an empty one of the same
columns; columns of other names than doc_id, text, lang, source and n_chars come through all stages but the last
with their values, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm import bpe, decontaminate, langid, linededup, minhash
from riffle.llm.common import materialize

#: Tells rows by id and text; rows that agree on both are equal to every stage.
_ROW = "_riffle_row"


def _marked(docs: DataFrame) -> DataFrame:
    return docs.withColumn(_ROW, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text"))


def _own_columns(docs: DataFrame, made: list[str], stage) -> DataFrame:
    """``stage`` over ``docs``, whose columns named like those that the stage makes are out of its way meanwhile."""
    aside = {c: f"_riffle_own_{c}" for c in docs.columns if c in made}
    out = stage(docs.withColumnsRenamed(aside))
    return out.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those that identification rejects go, with them null texts and texts without a letter."""
    model = langid.fit(langid.learnable(docs))
    return _own_columns(docs, ["lang_pred", "score", "cross_entropy", "rejected"], lambda d: langid.identify(d, model).where("not rejected"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; n_chars follows the text.  No row goes; null texts stay null."""
    found = linededup.boilerplate(docs)

    def strip(d: DataFrame) -> DataFrame:
        return linededup.strip_lines(d, found).withColumn("n_chars", F.length("text").cast("long"))

    return _own_columns(docs, ["n_lines", "n_cross_site", "n_removed", "_text_hash", "_cut", "_short"], strip)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id.  Rows without words or without an id stay."""
    rows = _marked(docs)
    gone = minhash.near_duplicates(rows, carry=[_ROW]).where("not kept").select(_ROW)
    return rows.join(gone.distinct(), _ROW, "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage.  Null and empty texts stay, null items match nothing."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _marked(docs)
    found = decontaminate.leaks(rows, items, doc_id=_ROW).select(F.col("doc_id").alias(_ROW))
    return rows.join(found.distinct(), _ROW, "left_anti").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, checked to decode to its text; null texts have none and decode to nothing."""
    words = bpe.vocabulary_text()
    back = bpe.encode_decode(docs.select("doc_id", "lang", "text"), words, ["doc_id", "lang", "text"])
    return back.select(
        "doc_id", "lang", "ids", F.size("ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES = [("language", language), ("lines", lines), ("duplicates", duplicates), ("benchmark", benchmark), ("tokens", tokens)]
#: Language models, edit distances and merges have no SQL; tests/llm/test_pipeline.py has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
