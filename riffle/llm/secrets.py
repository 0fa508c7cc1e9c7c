"""Secrets in text: long tokens as candidates, and a random forest that removes false positives.

Only DataFrame, SQL and MLlib functions.  The forest sees a candidate's length and mix of characters, how often
neighbouring characters change their class, how much of it is made of words that stand in other documents too
(counted over all of them), its path and the words around it.  It is trained on a bounded number of labelled
findings (``sample_rows``), chosen by a hash.

Where no labels are given, they come from what the text says of a finding: the name before it and whether that is
assigned.  These columns (MARKS) are no inputs of the forest, so it has to find the secrets by the other signs,
judges findings that no name speaks of, and may overrule a name.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import id_remainder, materialize, table
from riffle.llm.registry import query

TOKEN = r"[A-Za-z0-9+/_-]{16,}={0,2}"
SAMPLE_ROWS = 20_000
#: A word counts as known from this many documents on.
WORD_DOCS = 3
#: What names a secret, what names something else, and paths of samples.
SECRET_NAMES = "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|credential|bearer"
OTHER_NAMES = "example|sample|dummy|commit|revision|sha|md5|checksum|digest|uuid|card|phone|isbn|license"
SAMPLE_PATHS = "test|example|sample|fixture|mock|demo|docs?/"
FEATURES = [
    "f_length", "f_changes", "f_digits", "f_upper", "f_other", "f_kinds", "f_hex", "f_words", "f_path_sample", "f_path_depth",
    "f_quoted", "f_prose_before", "f_prose_after", "f_digits_around",
]
#: What labels are made of; not seen by the forest.
MARKS = ["m_secret_name", "m_other_name", "m_assigned"]


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(doc_id, path, start, token, before, after) of every token of 16 characters and more in whole texts.

    start is its place in the text; before holds up to three words and what stands before it in its own, after what
    follows.  A token that a word repeats comes up once for that word.  Null and empty texts have no candidates.
    """
    words = F.split(F.col("text"), r"[ \t\n\r\f\x0B]")
    held = docs.select(F.col(doc_id).alias("doc_id"), F.col(path).cast("string").alias("path"), F.col(text).alias("text")).where(F.col("text").rlike(TOKEN))
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get(F.col("words"), i).rlike(TOKEN))
    around = F.transform(places, lambda i: F.struct(
        F.get(F.col("words"), i).alias("word"),
        F.array_join(F.slice("words", F.greatest(F.lit(1), i - 2), F.least(F.lit(3), i)), " ").alias("before"),
        F.coalesce(F.get(F.col("words"), i + 1), F.lit("")).alias("after"),
        F.aggregate(F.slice("words", F.lit(1), i), F.lit(0), lambda n, w: n + F.length(w) + 1).alias("at"),
    ))
    found = held.withColumn("words", words).select("doc_id", "path", F.explode(around).alias("w"))
    tokens = found.select("doc_id", "path", "w", F.explode(F.array_distinct(F.regexp_extract_all("w.word", F.lit(f"({TOKEN})"), F.lit(1)))).alias("token"))
    inside = F.instr(F.col("w.word"), F.col("token"))
    return tokens.select(
        "doc_id", "path", (F.col("w.at") + inside - 1).cast("long").alias("start"), "token",
        F.concat_ws(" ", "w.before", F.substring(F.col("w.word"), F.lit(1), inside - 1)).alias("before"),
        F.concat(F.substring(F.col("w.word"), inside + F.length("token"), F.length("w.word")), F.lit(" "), "w.after").alias("after"),
    )


def known_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word) of all words of three ASCII letters and more that stand alone in at least ``WORD_DOCS`` documents."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"))
    counted = docs.select(F.explode(words).alias("word")).where(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= WORD_DOCS).select("word").where(F.col("word").rlike("^[a-z]+$"))


def _share(token: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(token, pattern, "")) / F.length(token)


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` with the columns of FEATURES and MARKS.  Without words around it, a finding has 0 for their shares.

    Equal rows get equal values; null paths count as empty; an empty table gives an empty one.
    """
    token = F.col("token")
    runs = F.array_distinct(F.regexp_extract_all(F.lower(token), F.lit("[a-z]{3,}"), F.lit(0)))
    distinct = found.select("token").distinct()
    covered = distinct.select("token", F.explode(runs).alias("word")).join(words, "word").groupBy("token").agg(F.sum(F.length("word")).alias("letters"))
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    lead = F.regexp_replace("before", r"""[\s=:"']+$""", "")  # without the signs that labels are made of
    before, path = F.lower("before"), F.lower(F.coalesce("path", F.lit("")))
    return found.join(covered, "token", "left").withColumns({
        "f_length": F.least(F.length(token), F.lit(200)).cast("double"),
        "f_changes": (F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) - 1) / (F.length(token) - 1),
        "f_digits": _share(token, "[^0-9]"),
        "f_upper": _share(token, "[^A-Z]"),
        "f_other": _share(token, "[A-Za-z0-9]"),
        "f_kinds": F.size(F.array_distinct(F.split(token, ""))) / F.length(token),
        "f_hex": flag(token.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "f_words": F.least(F.lit(1.0), F.coalesce(F.col("letters"), F.lit(0)) / F.length(token)),
        "f_path_sample": flag(path.rlike(SAMPLE_PATHS)),
        "f_path_depth": F.size(F.split(path, "/")).cast("double"),
        "f_quoted": flag(F.col("before").rlike(r"""["']$""") & F.col("after").rlike(r"""^["']""")),
        "f_prose_before": F.coalesce(F.try_divide(F.length(F.regexp_replace(lead, "[^A-Za-z ]", "")), F.length(lead)), F.lit(0.0)),
        "f_prose_after": F.coalesce(F.try_divide(F.length(F.regexp_replace("after", "[^A-Za-z ]", "")), F.length("after")), F.lit(0.0)),
        "f_digits_around": flag(F.concat("before", "after").rlike("[0-9]")),
        "m_secret_name": flag(before.rlike(SECRET_NAMES)),
        "m_other_name": flag(before.rlike(OTHER_NAMES)),
        "m_assigned": flag(F.col("before").rlike(r"""[=:]\s*["']?$""")),
    }).drop("letters")


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = 20, depth: int = 6) -> PipelineModel | None:
    """Forest from FEATURES and ``label`` (1 secret, 0 not); None unless both labels occur.

    At most about ``sample_rows`` rows of each label are used, chosen by a hash of the token, so the fit is bounded.
    """
    labelled = labelled.select(*FEATURES, F.col("label").cast("double").alias("label"), F.xxhash64("token", "before").alias("_place")).where("label is not null")
    labelled = materialize(labelled)
    rows = {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(rows) < 2:
        return None
    part = F.pmod("_place", F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("label") == 1, min(1.0, sample_rows / rows[1.0])).otherwise(min(1.0, sample_rows / rows[0.0]))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    data = assembler.transform(labelled.where(part < share))
    forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=7, probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted")
    return PipelineModel([assembler, forest.fit(data)])


def judge(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``found`` (with FEATURES) and score, the forest's share of votes for a secret; without a model, 1 for all."""
    if model is None:
        return found.withColumn("score", F.lit(1.0))
    return model.transform(found).withColumn("score", vector_to_array("_probability")[1]).drop("_features", "_probability", "_raw", "_predicted")


def name_labels(found: DataFrame) -> DataFrame:
    """Labels for findings where none are given: 1 if the words before name a secret and assign it, 0 if they do
    neither, else null (not learned from)."""
    named, assigned = F.col("m_secret_name") > 0, F.col("m_assigned") > 0
    return found.withColumn("label", F.when(named & assigned & (F.col("m_other_name") == 0), 1).when(~named & ~assigned, 0))


@query("op5_secret_scan")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all whole documents, with the share of trees that take them for one; learned from documents whose
    crc32 of the id modulo 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = materialize(features(candidates(docs), known_words(docs)))
    model = train(name_labels(found.where(id_remainder(F.col("doc_id"), 4) != 2)))
    return judge(found, model).where("score > 0.5").select("doc_id", "path", "start", F.length("token").cast("long").alias("length"), F.sha2("token", 256).alias("token_sha256"), "score")
