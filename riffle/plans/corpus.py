"""Question corpus, slide captions, image manifests and exam items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riffle.functions import clean as C
from riffle.functions import text as X
from riffle.operators.aggregates import dedup_first, flatten_lists, last_by
from riffle.operators.joins import prefix_join, questions_with_knowledge

OPTIONS = ("queAnsA", "queAnsB", "queAnsC", "queAnsD", "queAnsE")


def build_question_corpus(
    questions: DataFrame,
    links: DataFrame,
    knowledge: DataFrame,
    condition: Column,
    html_cols: Sequence[str],
    key: str = "question_uid",
    knowledge_key: str = "knowledge_uid",
    order: Sequence[str] = (),
    how: str = "left",
    require: Sequence[str] = ("qtext", "qimage"),
) -> DataFrame:
    """Distinct questions with their plain text and asset list, one row per id.

    Rows are reduced to one per id before the pages are parsed, and a row whose
    ``require`` columns are blank is dropped at the end.
    """
    joined = questions_with_knowledge(questions, links, knowledge, key, knowledge_key, condition, how)
    rows = joined.select(*questions.columns).distinct()
    first = dedup_first(rows, [key], order or [c for c in questions.columns if c != key])
    parsed = first.withColumns(
        {
            "qtext": F.flatten(F.array(*[F.coalesce(X.html_texts(F.col(c)), F.array().cast("array<string>")) for c in html_cols])),
            "qimage": F.flatten(
                F.array(
                    *[
                        F.coalesce(X.html_assets(F.col(c)), F.array().cast("array<string>"))
                        for c in html_cols
                    ]
                )
            ),
        }
    )
    rest = [c for c in questions.columns if c not in html_cols]
    return C.drop_blank(flatten_lists(parsed.select(*rest, "qtext", "qimage"), "qtext", "qimage"), require)


def slide_captions(slides: DataFrame, files: DataFrame) -> DataFrame:
    """Rows (picture, caption).

    ``slides``: path, scope, sources (list), texts (list).  ``files``: scope, name.  A
    picture gets the last kept text of its slide; if several slides show it, the last
    slide by path decides.
    """
    caption = F.try_element_at(F.filter(F.transform("texts", lambda t: F.btrim(t, F.lit(" \t\r\n"))), X.keep_caption_text), F.lit(-1))
    slim = slides.select("path", "scope", caption.alias("caption"), F.explode("sources").alias("source"))
    shown = slim.filter(F.col("caption").isNotNull()).withColumn("picture_id", X.source_id(F.col("source")))
    matched = prefix_join(files, shown, "scope", "name", "picture_id")
    pictures = last_by(shown, ["scope", "picture_id"], "path", ["caption", "path"])
    joined = matched.join(pictures, ["scope", "picture_id"])
    return last_by(joined, "name", "path", ["caption"]).withColumnRenamed("name", "picture")


def image_manifest(files: DataFrame, word: str = "grade") -> DataFrame:
    """Rows (path, label): the character after ``word`` in the path, as a number."""
    return files.select("path", C.char_after(F.col("path"), word).try_cast("int").alias("label"))


def exam_items(pages: DataFrame, answer_mark: str = X.ANSWER_MARK) -> DataFrame:
    """Ten text columns per exam item, from stored pages.

    ``pages``: sub_type, sub_con, marker, stem, images (list), options (list), answer.
    Rows whose marker names no known type are left out.
    """
    kind = X.question_type(F.col("marker"))
    no_options = F.array().cast("array<string>")
    options = F.when(kind == X.SHORT_ANSWER, no_options).otherwise(F.coalesce("options", no_options))
    return pages.filter(kind.isNotNull()).select(
        F.col("sub_type").alias("subType"),
        F.col("sub_con").alias("subCon"),
        kind.alias("queType"),
        X.stem_with_images(F.col("stem"), F.col("images")).alias("queCon"),
        *X.option_columns(options, OPTIONS),
        X.tail_from(F.col("answer"), answer_mark).alias("quePar"),
    )
