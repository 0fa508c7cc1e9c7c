"""Shared pieces of the training-data operators: word hashes over Arrow text, splits, tables in the shared folder."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.session import materialize

#: White space between words: 0x20 and 0x09 to 0x0D.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
PIECE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_PRIME = 0x9E3779B97F4A7C15
_PRIME_INVERSE = pow(_PRIME, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finalizer of splitmix64); one to one."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_PRIME))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", _PRIME), ("down", _PRIME_INVERSE)):
            steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Sums of code times power, so that any stretch's hash is a difference (see ``stretch_hash``)."""
    up, _ = _power_tables(len(codes) + 1)
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=out[1:])
    return out


def inverse_powers(n: int) -> np.ndarray:
    """What moves a difference of prefix sums that starts at each of n places to power 0."""
    return _power_tables(n + 1)[1][:n]


def stretch_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every stretch [start, end) of the codes behind ``prefix``; equal content, equal hash."""
    _, down = _power_tables(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a string column one after the other, and the n + 1 offsets; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``limit`` bytes of text; a longer text comes alone and whole.  After the last, freed memory goes back."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on after their task, next to those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # only glibc has it
        trim(0)


#: Bytes that surely begin a character that is not white space: visible ASCII, and first bytes of blocks without any.
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xF5] = True
_SOLID[[0xE1, 0xE2, 0xE3]] = False


def space_cuts(data: np.ndarray, offsets: np.ndarray, after_space: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of the texts begin, and which text each is of: at its start and before spaces that a visible character follows.

    ``after_space=False``: only before spaces that don't follow another space.
    """
    cut = np.zeros(len(data), dtype=bool)
    if len(data):
        space = data == 0x20
        cut[:-1] = space[:-1] & _SOLID[data[1:]]
        if not after_space:
            cut[1:] &= ~space[:-1]
        full = offsets[1:] > offsets[:-1]
        cut[offsets[1:][full] - 1] = False  # the next byte is another text's
        cut[offsets[:-1][full]] = True
    start = np.flatnonzero(cut)
    return start, np.searchsorted(offsets, start, side="right") - 1


def stretches(data: np.ndarray, start: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes from each start to the next one."""
    ends = np.append(start, len(data)).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def binary_list(values: pa.LargeBinaryArray) -> list[bytes]:
    """The values as Python bytes."""
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1].tolist() if len(values) else [0]
    raw = values.buffers()[2].to_pybytes() if ends[-1] else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def word_table(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of A-Z lower-cased texts, in order: row, first byte, byte after the last, 64-bit hash."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    low = _LOWER[data]
    word = ~_IS_SPACE[low]
    edge = np.zeros(len(low) + 1, dtype=bool)
    edge[offsets] = True
    starts = word.copy()
    starts[1:] &= ~word[:-1] | edge[1:-1]
    ends = word
    ends = ends.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return row, start, end, stretch_hash(prefix_hash(_BYTE_CODES[low]), start, end)


def shingle_hashes(row: np.ndarray, words: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row as sorted hashes: (hashes, n + 1 offsets); fewer words: the whole sequence as one."""
    per_row = np.bincount(row, minlength=rows).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(per_row)])
    prefix = prefix_hash(words)
    n = np.where(per_row >= k, per_row - k + 1, (per_row > 0).astype(np.int64))
    owner = np.repeat(np.arange(rows), n)
    at = np.arange(n.sum()) - np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) + first[owner]
    h = stretch_hash(prefix, at, at + np.minimum(per_row[owner], k))
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), dtype=bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int64)


def lower_az(text: Column) -> Column:
    """A-Z in lower case, all else as it is; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


__all__ = [
    "binary_list", "give_back", "id_remainder", "inverse_powers", "lower_az", "materialize", "mix64", "pieces", "prefix_hash", "shingle_hashes", "space_cuts",
    "stretch_hash", "stretches", "table", "text_bytes", "word_table",
]
