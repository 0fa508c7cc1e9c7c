"""Text and assets of stored pages, captions and exam items."""

from __future__ import annotations

import string
from collections.abc import Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Markers of exam pages and the question types they stand for.
SINGLE_CHOICE = "单选题"
MULTIPLE_CHOICE = "多选题"
SHORT_ANSWER = "简答题"
CASE_MARK = "案例题"
ANSWER_MARK = "正确答案"

#: Pages that are Python strings at once.
_SLICE = 64
_NO_PUNCTUATION = str.maketrans("", "", string.punctuation)


class _TextNodes(HTMLParser):
    """Text nodes of one document; script and style can be left out."""

    def __init__(self, skip_code: bool):
        super().__init__()
        self.skip_code = skip_code
        self.inside = 0
        self.nodes: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.inside += tag in ("script", "style")

    def handle_endtag(self, tag):
        self.inside -= tag in ("script", "style") and self.inside > 0

    def handle_data(self, data):
        if self.skip_code and self.inside:
            return
        plain = data.translate(_NO_PUNCTUATION)
        if plain and "\n" not in plain:
            self.nodes.append(plain)


def _text_nodes(page: str | None, skip_code: bool) -> list[str] | None:
    if page is None:
        return None
    parser = _TextNodes(skip_code)
    parser.feed(page)
    parser.close()
    return parser.nodes


def _nodes_of(pages: pa.Array, skip_code: bool) -> pa.Array:
    """Text nodes of a batch, some pages at a time, so that Python never holds the strings of a whole batch."""
    kind = pa.list_(pa.string())
    parts = (pages.slice(at, _SLICE).to_pylist() for at in range(0, len(pages), _SLICE))
    done = [pa.array([_text_nodes(p, skip_code) for p in part], kind) for part in parts]
    return pa.concat_arrays(done or [pa.array([], kind)])


@F.arrow_udf(T.ArrayType(T.StringType()))
def _texts(pages: pa.Array) -> pa.Array:
    return _nodes_of(pages, True)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _texts_with_code(pages: pa.Array) -> pa.Array:
    return _nodes_of(pages, False)


def html_texts(c: Column, skip_code: bool = True) -> Column:
    """Text nodes without ASCII punctuation; empty nodes and nodes with a line break go.

    Marked as not deterministic, though it is, so that a filter on the nodes does not parse every page a second time.
    """
    return (_texts if skip_code else _texts_with_code).asNondeterministic()(c)


def html_image_sources(c: Column) -> Column:
    """``src`` of every ``img`` element, in order."""
    return F.regexp_extract_all(c, F.lit(r"""(?i)<img\b[^>]*?\ssrc\s*=\s*["']([^"']*)["']"""), F.lit(1))


def html_style_urls(c: Column) -> Column:
    """Text between the first quotes in the style of every ``div`` that names a url."""
    styles = F.regexp_extract_all(c, F.lit(r"""(?i)<div\b[^>]*?\sstyle\s*=\s*"([^"]*url[^"]*)\""""), F.lit(1))
    return F.filter(
        F.transform(styles, lambda s: F.regexp_extract(s, "'([^']*)'", 1)), lambda s: s != ""
    )


def html_assets(c: Column) -> Column:
    """Image sources and style urls together, in the order they stand in the page."""
    elements = F.regexp_extract_all(c, F.lit(r"(?i)(<(?:img|div)\b[^>]*>)"), F.lit(1))
    found = F.transform(elements, lambda e: F.concat(html_image_sources(e), html_style_urls(e)))
    return F.flatten(found)


def html_links(c: Column) -> Column:
    """``href`` of every ``a`` element, in order."""
    return F.regexp_extract_all(c, F.lit(r"""<a href="([^"]*)\""""), F.lit(1))


def keep_caption_text(c: Column) -> Column:
    """True for text that is not blank, not all letters and not all digits."""
    t = F.btrim(c, F.lit(" \t\r\n"))
    return F.coalesce(
        (t != "") & ~t.rlike(r"^\p{L}+$") & ~t.rlike(r"^\p{Nd}+$"), F.lit(False)
    )


def source_id(c: Column) -> Column:
    """Part after the double slash; null where there is none."""
    return F.try_element_at(F.split(c, "//"), F.lit(2))


def question_type(c: Column) -> Column:
    """Type from the marker text; the first rule that fits decides."""
    return (
        F.when(c.contains("A") | c.contains("B"), SINGLE_CHOICE)
        .when(c.contains("X"), MULTIPLE_CHOICE)
        .when(c.contains(CASE_MARK) | c.contains(SHORT_ANSWER), SHORT_ANSWER)
    )


def option_columns(options: Column, names: Sequence[str]) -> list[Column]:
    """Blank options are skipped, the rest moves up, and missing places are empty."""
    present = F.filter(options, lambda o: o.isNotNull() & (o != ""))
    return [F.coalesce(F.get(present, i), F.lit("")).alias(n) for i, n in enumerate(names)]


def tail_from(c: Column, marker: str) -> Column:
    """Text without line breaks from ``marker`` on; the whole text if it is absent."""
    flat = F.replace(c, F.lit("\n"), F.lit(""))
    at = F.locate(marker, flat)
    return F.when(at > 0, F.substring(flat, at, F.length(flat))).otherwise(flat)


def stem_with_images(c: Column, images: Column) -> Column:
    """Stem followed by ``<source>`` for every image."""
    shown = F.transform(F.coalesce(images, F.array().cast("array<string>")), lambda s: F.concat(F.lit("<"), s, F.lit(">")))
    return F.concat(c, F.array_join(shown, ""))


def first_number(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d+\.?\d*)", 1), F.lit(""))
