"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of ``order`` characters over lower-cased letters, with every run of
other characters as one blank.  The levels lie in sorted hash arrays that all languages share; a
language is chosen by the lowest cross-entropy per character.

The fit takes a bounded sample: about ``sample_docs`` documents of each language, chosen by a
hash of the id, an eighth of them only for calibration.  Their counts are made by Spark; the driver gets
the grouped counts of the sample, whose size follows from that bound and not from the corpus.
Scoring reads every whole text where it lies, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import id_remainder, mix64, pieces, table
from riffle.llm.registry import query

ORDER = 5
SAMPLE_DOCS = 2000
#: A document is rejected this many deviations above its language's usual cross-entropy.
REJECT_AT = 8.0
BLANK, START = 32, 1
#: Bytes of text worked on at once: about 60 bytes of working memory for each.
PIECE = 1 << 20
_BETWEEN = "\ud800"  # no text in a table can hold it


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Code of every code point: its lower-case letter or mark, else a blank."""
    codes = np.full(0x110000, BLANK, dtype=np.uint32)
    for i in range(0x40, 0x32400):
        c = chr(i)
        if unicodedata.category(c)[0] in "LM":
            low = c.lower()
            codes[i] = ord(low) if len(low) == 1 else i
    codes[ord(_BETWEEN)] = START
    return codes


def character_codes(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all texts, each after ``order - 1`` start marks, and the row of every code."""
    gap = _BETWEEN * (order - 1)
    joined = gap + gap.join(f" {t or ''} " for t in texts)
    codes = _folding()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != BLANK) | (codes[:-1] != BLANK)
    codes = codes[keep]
    begins = codes == START
    begins[1:] &= codes[:-1] != START
    return codes, np.cumsum(begins) - 1


def _hash_step(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return mix64(h * np.uint64(0x9E3779B97F4A7C15) + codes.astype(np.uint64) + np.uint64(1))


def suffix_hashes(grams: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each length k from 1: hash of the last k codes of every row, and of those but the last code."""
    whole, context = [], []
    h = g = np.zeros(len(grams), dtype=np.uint64)
    for k in range(1, grams.shape[1] + 1):
        h = _hash_step(h, grams[:, -k])
        if k > 1:
            g = _hash_step(g, grams[:, -k])
        whole.append(h)
        context.append(g)
    return whole, context


def _distinct_grams(codes: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places that end a gram (start marks aside), the distinct grams, and which one ends at each place."""
    places = np.flatnonzero(codes != START)
    h = np.zeros(len(places), dtype=np.uint64)
    for k in range(order):
        h = h * np.uint64(0x9E3779B97F4A7C15) + mix64(codes[places - k].astype(np.uint64) + np.uint64(1))
    _, first, which = np.unique(h, return_index=True, return_inverse=True)
    grams = np.stack([codes[places[first] - k] for k in range(order - 1, -1, -1)], axis=1)
    return places, grams, which


@dataclass
class Model:
    order: int
    langs: list[str]
    alphabet: int = 1
    #: by length k: sorted hashes of grams with their discounted shares, and of contexts with the mass left to shorter ones
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None  # variance: spread[:, 0] + spread[:, 1] / characters

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """Natural log of the last code's probability after the others, a column for each language."""
        p = np.full((len(grams), len(self.langs)), 1.0 / (self.alphabet + 1))
        for k, (whole, context) in enumerate(zip(*suffix_hashes(grams))):
            p *= _lookup(*self.contexts[k], context, 1.0)
            p += _lookup(*self.grams[k], whole, 0.0)
        return np.log(p)

    def cross_entropy(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Mean negative log-probability per character [row, language], the same with each character under its
        best language, characters, letters of each text."""
        codes, row = character_codes(texts, self.order)
        places, grams, which = _distinct_grams(codes, self.order)
        cost = -self.log_probabilities(grams)
        n = np.bincount(row[places], minlength=len(texts))
        letters = np.bincount(row[places], weights=codes[places] != BLANK, minlength=len(texts))
        every = np.column_stack([cost, cost.min(axis=1)])
        total = np.stack([np.bincount(row[places], weights=c[which], minlength=len(texts)) for c in every.T], axis=1)
        total /= np.maximum(n, 1)[:, None]
        return total[:, :-1], total[:, -1], n, letters


def _lookup(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full((len(asked), values.shape[1]), missing)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where((keys[at] == asked)[:, None], values[at], missing)


def smooth(lang: np.ndarray, grams: np.ndarray, count: np.ndarray, langs: list[str]) -> Model:
    """The Kneser-Ney levels from the counts of the longest grams of each language (``lang``: its number)."""
    order, size = grams.shape[1], len(langs)
    model = Model(order, langs, alphabet=len(np.unique(grams)))
    whole, context = suffix_hashes(grams)
    level_lang, level_at, level_count = lang, np.arange(len(lang)), count.astype(np.float64)
    for k in range(order - 1, -1, -1):
        w, c = whole[k][level_at], context[k][level_at]
        share, left = {}, {}
        for j in range(size):
            own = level_lang == j
            n1, n2 = np.sum(level_count[own] == 1), np.sum(level_count[own] == 2)
            discount = min(0.95, max(0.1, n1 / max(1, n1 + 2 * n2)))
            keys, group = np.unique(c[own], return_inverse=True)
            total = np.bincount(group, weights=level_count[own], minlength=len(keys))
            kinds = np.bincount(group, minlength=len(keys))
            share[j] = (w[own], (level_count[own] - discount) / total[group])
            left[j] = (keys, discount * kinds / np.maximum(total, 1e-300))
        model.grams.insert(0, _side_by_side(share, 0.0))
        model.contexts.insert(0, _side_by_side(left, 1.0))
        if k:  # a shorter gram counts the different codes seen before it
            mark = mix64(whole[k - 1][level_at] ^ mix64(level_lang.astype(np.uint64)))
            _, first, group = np.unique(mark, return_index=True, return_inverse=True)
            level_lang, level_at, level_count = level_lang[first], level_at[first], np.bincount(group).astype(np.float64)
    return model


def _side_by_side(by_lang: dict[int, tuple[np.ndarray, np.ndarray]], missing: float) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.concatenate([k for k, _ in by_lang.values()]))
    values = np.full((len(keys), len(by_lang)), missing, dtype=np.float32)
    for j, (k, v) in by_lang.items():
        values[np.searchsorted(keys, k), j] = v
    return keys, values


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) over the given (text, lang): gram is ``order`` codes of four bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            langs, texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                codes, _ = character_codes([t for t, g in zip(texts, langs) if g == lang], order)
                _, grams, which = _distinct_grams(codes, order)
                raw = grams.astype("<u4").tobytes()
                cut = [raw[i : i + 4 * order] for i in range(0, len(raw), 4 * order)]
                n = np.bincount(which, minlength=len(cut)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cut), pa.string()), pa.array(cut, pa.binary()), pa.array(n)], names=["lang", "gram", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit(labelled: DataFrame, order: int = ORDER, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """Model from (doc_id, text, lang); rows with a null in one of them teach nothing; None without any row."""
    labelled = labelled.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null")
    rows = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return None
    langs = sorted(rows)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    taken = F.create_map(*(F.lit(x) for lang in langs for x in (lang, int(min(1.0, sample_docs / rows[lang]) * (1 << 30)))))
    sample = labelled.where(place < taken[F.col("lang")]).withColumn("check", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(8)) == 0)
    counted = count_grams(sample.where("not check"), order).toArrow()
    if not counted.num_rows:
        return None
    grams = np.frombuffer(b"".join(counted.column("gram").to_pylist()), dtype="<u4").reshape(-1, order)
    number = {g: j for j, g in enumerate(langs)}
    model = smooth(np.array([number[g] for g in counted.column("lang").to_pylist()]), grams, counted.column("n").to_numpy(), langs)
    return _calibrate(model, sample.where("check"))


def _calibrate(model: Model, held: DataFrame) -> Model:
    """Usual cross-entropy of each language and how it varies with length, from documents that were not counted.

    Each character counts under its best language, so that texts in two languages are not taken for noise.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=PIECE):
            _, free, n, letters = model.cross_entropy(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(free), pa.array(np.where(letters > 0, n, 0))], names=["lang", "cost", "n"])

    seen = held.select("text", "lang").mapInArrow(run, "lang string, cost double, n long").where("n > 0").toPandas()
    size = len(model.langs)
    model.usual, model.spread = np.full(size, np.inf), np.ones((size, 2))
    for j, lang in enumerate(model.langs):
        own = seen[seen.lang == lang]
        if len(own) >= 8:
            model.usual[j] = own.cost.median()
            square = (own.cost - model.usual[j]) ** 2
            model.spread[j] = square.mean(), (square * own.n).median() + 1.0
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text", reject_at: float = REJECT_AT) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1, how far the best language leads), cross_entropy and rejected.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is
    everything without a model.  Equal languages: the first in order of name.  Columns of these names are replaced.
    """
    names = ["lang_pred", "score", "cross_entropy", "rejected"]
    kept = [f for f in docs.schema if f.name not in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, PIECE):
            own = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            rows = batch.num_rows
            if model is None:
                new = [pa.array(["und"] * rows), pa.array(np.zeros(rows)), pa.array([None] * rows, pa.float64()), pa.array(np.ones(rows, bool))]
            else:
                cost, free, n, letters = model.cross_entropy(batch.column(batch.schema.get_field_index(text)).to_pylist())
                best = cost.argmin(axis=1)
                least = cost[np.arange(rows), best]
                score = 1.0 / np.exp((least[:, None] - cost) * np.minimum(n, 100)[:, None]).sum(axis=1)
                far = free > model.usual[best] + reject_at * np.sqrt(model.spread[best, 0] + model.spread[best, 1] / np.maximum(n, 1))
                none = letters == 0
                new = [
                    pa.array(["und" if z else model.langs[j] for z, j in zip(none, best)]), pa.array(np.where(none, 0.0, score)),
                    pa.array(least, mask=none), pa.array(far | none),
                ]
            yield pa.RecordBatch.from_arrays([*own, *new], names=[*(f.name for f in kept), *names])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(run, f"{kinds}, lang_pred string, score double, cross_entropy double, rejected boolean")


def learnable(docs: DataFrame) -> DataFrame:
    """The documents that may teach: crc32 of the id modulo 4 is not 2."""
    return docs.where(id_remainder(F.col("doc_id"), 4) != 2)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(learnable(docs))
    held = F.coalesce(id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
