"""Benchmark passages in documents, found by the q-gram lemma and confirmed by banded alignment.

Texts are folded to lower-case letters, digits and single blanks.  Every benchmark item is cut to
windows of ``WINDOW`` characters, each half over the last (a shorter item is one window), so any
quotation of one and a half windows holds a whole one.  A window occurs in a document if some stretch of
it is at most ``m // 16`` edits away (m: the window's length).

Such a stretch shares at least m - Q + 1 - Q * edits character q-grams with the window, and they
lie on edits + 1 neighbouring diagonals.  So shared q-grams are counted in bands of 2 * (edits + 1)
diagonals that overlap by half; bands that reach the bound are aligned exactly, within the band.

The benchmark is the stated query set.  It is read in blocks of ``BLOCK_CHARS`` characters, and
each block meets all documents where they lie, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import inverse_powers, pieces, prefix_hash, table
from riffle.llm.registry import query

Q = 10
WINDOW = 96
#: Folded items shorter than this are no passages and are not searched.
LEAST = 24
BLOCK_CHARS = 1 << 20
_BITS = 22
_GAP = "\ud800" * 16  # between texts; longer than any edit budget, in no table


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    codes = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x30, 0x32400):
        c = chr(i)
        if unicodedata.category(c)[0] in "LMN":
            low = c.lower()
            codes[i] = ord(low) if len(low) == 1 else i
    codes[ord(_GAP[0])] = 0
    return codes


def folded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Folded codes of all texts with gaps of zeros around each, and the place in the joined texts of each code."""
    joined = _GAP + _GAP.join(t or "" for t in texts) + _GAP
    codes = _folding()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    keep = codes != 32
    keep[1:] |= (codes[:-1] != 32) & (codes[:-1] != 0)
    place = np.flatnonzero(keep)
    return codes[place], place


def edit_budget(m: int) -> int:
    return min(m // 16, (m - Q) // Q)


@dataclass
class Windows:
    """One block of the benchmark: windows, their q-grams by hash, and a bit table that most texts' q-grams miss."""

    items: np.ndarray  # item of each window
    codes: list[np.ndarray]
    keys: np.ndarray
    starts: np.ndarray  # entries of key i: starts[i] to starts[i + 1]
    window: np.ndarray
    offset: np.ndarray
    bits: np.ndarray


def cut(items: list[tuple[int, str]]) -> Windows:
    owner, windows = [], []
    for item, text in items:
        codes, _ = folded([text])
        codes = codes[codes != 0]
        codes = codes[:-1] if len(codes) and codes[-1] == 32 else codes
        if len(codes) < LEAST:
            continue
        last = max(0, len(codes) - WINDOW)
        for at in sorted({*range(0, last, WINDOW // 2), last}):
            owner.append(item)
            windows.append(codes[at : at + WINDOW])
    hashes = [_gram_hashes(w) for w in windows]
    flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
    window = np.repeat(np.arange(len(windows)), [len(h) for h in hashes])
    offset = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    keys, starts = np.unique(flat[order], return_index=True)
    bits = np.zeros(1 << _BITS, dtype=bool)
    bits[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Windows(np.array(owner, dtype=np.int64), windows, keys, np.append(starts, len(flat)), window[order], offset[order], bits)


def _gram_hashes(codes: np.ndarray) -> np.ndarray:
    """64-bit hash of the q-gram at each place: the difference of two prefix sums, moved to power 0."""
    n = len(codes) - Q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    prefix = prefix_hash(codes.astype(np.uint64))
    return (prefix[Q:] - prefix[:n]) * inverse_powers(n)


def occurrences(codes: np.ndarray, index: Windows) -> list[tuple[int, int, int, int]]:
    """(window, start, end, edits) of the best stretch in every band of the codes that holds an occurrence."""
    h = _gram_hashes(codes)
    place = np.flatnonzero(index.bits[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
    if not len(place) or not len(index.keys):
        return []
    at = np.minimum(np.searchsorted(index.keys, h[place]), len(index.keys) - 1)
    hit = index.keys[at] == h[place]
    place, at = place[hit], at[hit]
    n = index.starts[at + 1] - index.starts[at]
    counted = []
    for part in np.array_split(np.arange(len(place)), 1 + int(n.sum()) // (1 << 22)):
        entry = np.repeat(index.starts[at[part]], n[part]) + _steps(n[part])
        window = index.window[entry]
        step = _budgets(index)[window] + 1
        band = (np.repeat(place[part], n[part]) - index.offset[entry] + WINDOW) // step
        key = window.astype(np.int64) << 40 | band
        counted.append(np.unique(np.concatenate([key, key - 1]), return_counts=True))
    keys, which = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
    shared = np.bincount(which, weights=np.concatenate([c for _, c in counted]))
    sizes = np.array([len(w) for w in index.codes])
    window, band = keys >> 40, keys & ((1 << 40) - 1)
    budget = _budgets(index)[window]
    enough = shared >= sizes[window] - Q + 1 - Q * budget
    found = []
    for m in np.unique(sizes[window[enough]]).tolist():
        own = np.flatnonzero(enough & (sizes[window] == m))
        k = edit_budget(m)
        low = band[own] * (k + 1) - WINDOW - k  # first diagonal of the band, less what the edits can shift
        patterns = np.stack([index.codes[w] for w in window[own]])
        for at in range(0, len(own), 4096):
            part = slice(at, at + 4096)
            start, end, edits = aligned(patterns[part], codes, low[part], 4 * k + 2, k)
            near = edits <= k
            found += zip(window[own[part]][near].tolist(), start[near].tolist(), end[near].tolist(), edits[near].tolist())
    return found


def _steps(n: np.ndarray) -> np.ndarray:
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)


def _budgets(index: Windows) -> np.ndarray:
    return np.array([edit_budget(len(w)) for w in index.codes], dtype=np.int64)


def aligned(patterns: np.ndarray, codes: np.ndarray, low: np.ndarray, width: int, budget: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and edits of the stretch nearest to each pattern on ``width`` diagonals from its ``low``; beyond the budget edits are too many.

    Cell j of row i ends a stretch at text place low + i + j; gaps of zeros match nothing.  Patterns that stand
    in the text letter by letter need no alignment.
    """
    far = np.int64(1 << 20)
    lane = np.arange(width)
    rows, m = patterns.shape
    padded = np.concatenate([np.zeros(WINDOW + width, codes.dtype), codes, np.zeros(WINDOW + 2 * width, codes.dtype)])
    origin = low + WINDOW + width  # place of diagonal 0 of the band in the padded text
    starts, ends, edits = low.copy(), low + m, np.full(rows, far)
    spans = np.lib.stride_tricks.sliding_window_view(padded, m)
    for j in range(width):
        todo = np.flatnonzero(edits > 0)
        same = todo[(spans[origin[todo] + j] == patterns[todo]).all(axis=1)]
        starts[same], ends[same], edits[same] = low[same] + j, low[same] + j + m, 0
    todo = np.flatnonzero(edits > 0)
    at = low[todo, None] + lane
    cost = np.where((at < 0) | (at > len(codes)), far, 0)
    began = at
    for i in range(1, m + 1):
        if not len(todo):
            return starts, ends, edits
        spot = low[todo, None] + (i - 1) + lane
        across = cost + (padded[spot + WINDOW + width] != patterns[todo, i - 1][:, None])
        across[(spot < 0) | (spot >= len(codes))] = far
        down = np.concatenate([cost[:, 1:], np.full((len(todo), 1), far)], axis=1) + 1  # a pattern code without a text code
        take = np.minimum(across, down)
        source = np.where(across <= down, began, np.concatenate([began[:, 1:], began[:, -1:]], axis=1))
        reach = np.minimum.accumulate((take - lane) * width + lane, axis=1)  # text codes without a pattern code
        lead = reach % width
        cost = np.take_along_axis(take, lead, axis=1) + lane - lead
        began = np.take_along_axis(source, lead, axis=1)
        live = cost.min(axis=1) <= budget
        todo, cost, began = todo[live], cost[live], began[live]
    if len(todo):
        j = cost.argmin(axis=1)
        row = np.arange(len(todo))
        starts[todo], ends[todo], edits[todo] = began[row, j], low[todo] + m + j, cost[row, j]
    return starts, ends, edits


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, first_char, end_char, n_windows, edits) for every row of ``docs`` and benchmark item found in it.

    The span covers all windows of the item found, in characters of the whole text; edits are
    those of the nearest window.  Null and empty texts, and items that are null or fold to fewer than
    ``LEAST`` characters, give no rows; a repeated document or item gives its rows again.  Columns
    of other names are not read.
    """
    found = [_leaks_of(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), cut(block)) for block in _blocks(benchmark)]
    if not found:
        return docs.sparkSession.createDataFrame([], _LEAKS)
    return reduce(DataFrame.unionByName, found)


_LEAKS = "doc_id long, item_id long, first_char long, end_char long, n_windows long, edits long"


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    for item, text in rows.toLocalIterator():
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append((item, text))
        size += len(text)
    if block:
        yield block


def _leaks_of(docs: DataFrame, index: Windows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            codes, place = folded(texts)
            first = np.cumsum([len(_GAP)] + [len(t or "") + len(_GAP) for t in texts])
            spans: dict[tuple[int, int], list] = {}
            for w, start, end, edits in occurrences(codes, index):
                a, b = int(place[start]), int(place[end - 1]) + 1
                row = int(np.searchsorted(first, a, side="right")) - 1
                spans.setdefault((row, int(index.items[w])), []).append((a - int(first[row]), b - int(first[row]), w, edits))
            rows = [
                (ids[row], item, min(s[0] for s in got), max(s[1] for s in got), len({s[2] for s in got}), min(s[3] for s in got))
                for (row, item), got in sorted(spans.items())
            ]
            columns = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.split()[0] for f in _LEAKS.split(", ")])

    return docs.mapInArrow(run, _LEAKS)


@query("op2_benchmark_leaks")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in whole documents."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
