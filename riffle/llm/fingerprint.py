"""Improbable-feature digests: rare byte windows in chained Bloom filters.

A feature is a window of 64 bytes.  Its rank is how common its entropy (thousandths of the most possible) is among
all windows of all documents: the rarer, the better.  In every stretch of 64 windows the best one scores
a point; windows with ``POINTS`` points are features of the text.  They go, in order, to Bloom
filters of 2,048 bits, ``PER_FILTER`` to each.  Entropies are sums of whole numbers, so equal
texts give equal fingerprints wherever they lie.

The histogram of entropies has 1,001 rows at any size.  For the next document in the order of
ids, texts are dealt to ranges once, and the first row of each range goes to the range before as well.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import PIECE_BYTES, mix64, pieces, prefix_hash, stretch_hash, table, text_bytes
from riffle.llm.registry import query

WIDTH = 64
POINTS = 16
FILTER_BITS = 2048
HASHES = 5
PER_FILTER = 160
#: Windows below or above (runs of few bytes, random bytes) say little about a text.
LEAST_ENTROPY, MOST_ENTROPY = 100, 990
#: Share of the possible overlap that counts as chance.
CHANCE = 0.3
#: A range of ids holds about half as many bytes of text, so tasks stay alike however large the table is.
RANGE_BYTES = 256 << 20
_SCALE = 1 << 20
_FLOG = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WIDTH + 1)], dtype=np.int64)
_ADDED = np.diff(_FLOG)
_TILE = 1 << 17


def window_entropies(data: np.ndarray) -> np.ndarray:
    """Entropy, in thousandths of six bits, of the window that starts at each byte (the last 63 are no windows)."""
    n = len(data)
    out = np.zeros(max(0, n - WIDTH + 1), dtype=np.int16)
    for at in range(0, len(out), _TILE):
        part = data[at : at + _TILE + WIDTH - 1]
        before, after = np.zeros((2, len(part)), dtype=np.uint8)
        for k in range(1, WIDTH):
            same = part[:-k] == part[k:]
            before[k:] += same
            after[:-k] += same
        change = _ADDED[before]
        change[WIDTH:] -= _ADDED[after[:-WIDTH]]
        total = np.cumsum(change)[WIDTH - 1 :]
        out[at : at + len(total)] = (WIDTH * 6 * _SCALE - total) * 1000 // (WIDTH * 6 * _SCALE)
    return out


def _window_rows(offsets: np.ndarray, n: int) -> np.ndarray:
    """Whether a window that starts at each byte lies within one text."""
    inside = np.zeros(n, dtype=bool)
    if len(inside):
        room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(offsets[-1])
        inside = room[:n] >= WIDTH
    return inside


def ranks(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Rank of each entropy, 0 the rarest among all windows of all documents; those that say little have the last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1001, dtype=np.int64)
        for batch in pieces(batches, text):
            data, offsets = text_bytes(batch.column(0))
            entropy = window_entropies(data)
            total += np.bincount(entropy[_window_rows(offsets, len(entropy))], minlength=1001)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(1001)), pa.array(total)], names=["entropy", "n"])

    counted = docs.select(F.col(text)).mapInArrow(run, "entropy long, n long").groupBy("entropy").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(1001, dtype=np.int64)
    n[counted.entropy] = counted.n
    out = np.empty(1001, dtype=np.int64)
    out[np.lexsort((np.arange(1001), n))] = np.arange(1001)
    out[:LEAST_ENTROPY] = out[MOST_ENTROPY + 1 :] = 1001
    return out


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the features of all texts, in order and each hash once per text."""
    rows = len(offsets) - 1
    entropy = window_entropies(data)
    inside = _window_rows(offsets, len(entropy))
    n = len(entropy)
    last = np.int64(1) << 62
    key = np.where(inside, rank[entropy] << 40 | np.arange(n), last) if n else np.zeros(0, np.int64)
    best = key.copy()
    for step in (1, 2, 4, 8, 16, 32):
        best = np.minimum(best[:-step], best[step:]) if len(best) > step else best[:0]
    size = np.diff(offsets)
    windows = np.maximum(size - WIDTH + 1, 0)
    # stretches of 64 windows inside one text
    whole = inside[: len(best)] & inside[WIDTH - 1 :][: len(best)] if len(best) else np.zeros(0, bool)
    if len(whole):
        owner = np.repeat(np.arange(rows), size)
        whole &= owner[: len(whole)] == owner[WIDTH - 1 : WIDTH - 1 + len(whole)]
    chosen, points = np.unique(best[whole], return_counts=True)
    short = np.flatnonzero((windows > 0) & (windows < WIDTH))
    if len(short):  # one stretch holds all windows
        at = np.stack([offsets[short], offsets[short] + windows[short]], axis=1).ravel()
        chosen = np.concatenate([chosen, np.minimum.reduceat(np.append(key, last), at)[::2]])
        points = np.concatenate([points, np.full(len(short), POINTS)])
    take = (points >= POINTS) & (chosen >> 40 <= 1000)
    place = np.sort(chosen[take] & ((1 << 40) - 1))
    row = np.searchsorted(offsets, place, side="right") - 1
    codes = prefix_hash(mix64(data.astype(np.uint64) + np.uint64(1)))
    hashes = stretch_hash(codes, place, place + WIDTH)
    bare = np.setdiff1d(np.flatnonzero(size > 0), row)  # nothing stands out: the whole text is the feature
    row = np.concatenate([row, bare])
    hashes = np.concatenate([hashes, stretch_hash(codes, offsets[bare], offsets[bare + 1])])
    place = np.concatenate([place, offsets[bare]])
    order = np.lexsort((place, hashes, row))
    keep = np.ones(len(order), dtype=bool)
    keep[1:] = (row[order][1:] != row[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    order = order[keep]
    order = order[np.lexsort((place[order], row[order]))]
    return row[order], hashes[order]


class Prints:
    """Fingerprints of some texts: filters of text i are those from ``at[i]`` to ``at[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rank: np.ndarray):
        rows = len(offsets) - 1
        row, hashes = features(data, offsets, rank)
        held = np.bincount(row, minlength=rows)
        filters = -(-held // PER_FILTER)
        self.at = np.concatenate([[0], np.cumsum(filters)])
        nth = np.arange(len(row)) - np.repeat(np.cumsum(held) - held, held)
        home = self.at[row] + nth // PER_FILTER
        bits = np.zeros((self.at[-1], FILTER_BITS), dtype=bool)
        for k in range(HASHES):
            bits[home, (hashes >> np.uint64(11 * k)).astype(np.int64) & (FILTER_BITS - 1)] = True
        self.filters = np.packbits(bits, axis=1)
        self.set = bits.sum(axis=1)
        self.held = np.bincount(home, minlength=self.at[-1])
        self.total = held

    def text(self, i: int) -> str:
        return f"{self.total[i]}:{base64.b64encode(self.filters[self.at[i] : self.at[i + 1]].tobytes()).decode()}"


def likeness(a: Prints, i: int, b: Prints, j: int) -> float:
    """Overlap of two fingerprints, 0 to 1: each filter of the shorter one against its best match, weighted by features."""
    x, y = slice(a.at[i], a.at[i + 1]), slice(b.at[j], b.at[j + 1])
    if x.stop - x.start > y.stop - y.start or (x.stop - x.start == y.stop - y.start and a.total[i] > b.total[j]):
        a, x, b, y = b, y, a, x
    if x.stop == x.start:
        return float(y.stop == y.start)
    miss = (1 - 1 / FILTER_BITS) ** HASHES
    q = miss ** b.held[y]
    best = np.empty(x.stop - x.start)
    for k, f in enumerate(range(x.start, x.stop)):  # one filter against all of the longer text, so memory stays that of one text
        common = np.bitwise_count(a.filters[f] & b.filters[y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(a.set[f], b.set[y])
        least = FILTER_BITS * (1 - miss ** a.held[f]) * (1 - q)
        floor = CHANCE * np.maximum(most - least, 0) + np.minimum(least, most)
        score = np.where(common == most, 1.0, (common - floor) / np.maximum(most - floor, 1e-9))
        best[k] = np.clip(score, 0, 1).max()
    return float(np.average(best, weights=a.held[x]))


def _ranges(docs: DataFrame, parts: int) -> tuple[np.ndarray, DataFrame]:
    """First id of every range, and the rows with (id, range, tail): the first row of a range comes again as the tail of the one before."""
    lowest = -(1 << 63)
    keyed = docs.withColumn("id", F.coalesce(F.col("doc_id"), F.lit(lowest)))
    cuts = sorted({int(x) for x in keyed.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts)}) if parts > 1 else []
    edges = np.array([lowest, *cuts], dtype=np.int64)
    number = lambda ids: np.searchsorted(edges, ids, side="right") - 1

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(number(ids)), pa.array(ids)], names=["range", "id"])

    firsts = keyed.select("id").mapInArrow(least, "range long, id long").groupBy("range").agg(F.min("id").alias("id")).orderBy("range").collect()
    first = np.array([r.id for r in firsts], dtype=np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id")).to_numpy()
            own = np.searchsorted(first, ids, side="right") - 1
            head = np.flatnonzero(first[own] == ids)
            for rows, ranges, tail in ((batch, own, False), (batch.take(pa.array(head)), (own[head] - 1) % max(1, len(first)), True)):
                columns = [*rows.columns, pa.array(ranges.astype(np.int64)), pa.array(np.full(rows.num_rows, tail))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "range", "tail"])

    return first, keyed.mapInArrow(deal, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.schema) + ", range long, tail boolean")


def edited(text: str, after: str) -> str:
    """The last half of the text gives way to as much of the next one's beginning."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def compare_with_next(docs: DataFrame, rank: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next) of every row of (doc_id, text).

    The next document is that of the next larger id, of the first id after the last; rows that
    repeat an id are ordered by text.  Null texts count as empty; a null id comes before all others.
    An empty text has no filters and is like other empty ones only.  A single document is its own next one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rank = ranks(docs) if rank is None else rank
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    _, dealt = _ranges(docs, 2 * parts)
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "tail", "id", "text")
    return ordered.mapInArrow(_print_pairs(rank), "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def _print_pairs(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (range, tail, doc_id, text) in order; the last waits for its next one
        size = 0
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("range", "tail", "doc_id", "text")]
            for row in zip(*columns):
                held.append(row)
                size += len(row[3])
                if size > PIECE_BYTES // 2:
                    yield _printed(held, rank)
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield _printed(held, rank)

    return run


def _printed(rows: list[tuple], rank: np.ndarray) -> pa.RecordBatch:
    own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i][0] == rows[i + 1][0]]
    texts = [r[3] for r in rows]
    changed = [edited(texts[i], texts[i + 1]) for i in own]
    prints = Prints(*text_bytes(pa.array(texts, pa.large_string())), rank)
    after = Prints(*text_bytes(pa.array(changed, pa.large_string())), rank)
    columns = [
        pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(texts[i]) for i in own], pa.int64()), pa.array(changed, pa.string()),
        pa.array([prints.text(i) for i in own], pa.string()), pa.array([after.text(k) for k in range(len(own))], pa.string()),
        pa.array([likeness(prints, i, after, k) for k, i in enumerate(own)], pa.float64()),
        pa.array([likeness(prints, i, prints, i + 1) for i in own], pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


@query("op8_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document against its edited text and the next document."""
    out = compare_with_next(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
