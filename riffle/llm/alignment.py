"""Alignment of two tokenizers' tokens over the same bytes by merge-path partitioning, with corpus-wide pair counts.

Both tokenizers give rising byte ends.  Merging the two lists of ends walks through all overlaps: the tokens at
the front of both lists overlap, and the one that ends first is consumed.  A binary search on every ``WORK``-th diagonal of
the merge grid says how many ends of each list come before it, which cuts the merge into independent pieces of equal work.
All pieces of a batch step side by side; each emits its overlaps and the places where both tokens end, and running
sums over pieces stitch what crosses a border into groups.

Texts are cut before a space that follows no space and that a visible character follows: there both vocabularies cut as
well, so each different stretch of a chunk is encoded and aligned once, and a document is the sum of its stretches.  (A text with a
stretch whose bytes a tokenizer changes is encoded whole.)  A chunk holds about ``CHUNK_STRETCHES`` of them and asks once for every
different pair of ids; so no pair has more rows than there are chunks, and the counts travel back by one join and one
grouping by chunk.  The best count of each B id is one row per vocabulary entry.

Defined results: null and empty texts, and texts whose joined token bytes differ from space and text, have zeros and an empty
``groups``; repeated rows and ids are rows of their own and count each; a null id stays null; an empty table gives no rows;
other columns are left out, so their names can't clash.  Long texts are encoded whole; a text without spaces is one stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riffle.llm.bpe import SPLIT, Codec, _printable_bytes
from riffle.llm.common import binary_list, give_back, materialize, pieces, space_cuts, stretches, table, text_bytes
from riffle.llm.registry import query

WORK = 128
CHUNK_STRETCHES = 1_000_000
#: Chunks in one file: Parquet holds a row group whole as it is written, and Spark reads thousands of rows at once.
CHUNKS_PER_FILE = 4


def splits(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of ``a_ends`` are among the first d merged ends, for each diagonal d; of equal ends, A's comes first."""
    low = np.maximum(0, diagonals - len(b_ends))
    high = np.minimum(diagonals, len(a_ends))
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) >> 1
        before = a_ends[mid] <= b_ends[diagonals[open_] - 1 - mid]
        low[open_[before]] = mid[before] + 1
        high[open_[~before]] = mid[~before]
    return low


def merge_path(a_ends: np.ndarray, b_ends: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping pairs (places in A, places in B) in order, and the places after each group's last token in A and in B.

    Both lists rise and have the same last end.  Tokens without bytes overlap nothing.
    """
    n_a, n_b = len(a_ends), len(b_ends)
    if not n_a:
        return (np.zeros(0, np.int64),) * 4
    start = np.arange(0, n_a + n_b, work)
    i = splits(a_ends, b_ends, start)
    j = start - i
    a_start, b_start = np.append(0, a_ends), np.append(0, b_ends)
    far = a_ends[-1] + 1
    a_end, b_end = np.append(a_ends, far), np.append(b_ends, far)
    steps = min(work, n_a + n_b)
    at_a, at_b = np.zeros((2, steps, len(start)), np.int64)
    overlap, closes = np.zeros((2, steps, len(start)), bool)
    for step in range(steps):
        ends_a, ends_b = a_end[i], b_end[j]
        at_a[step], at_b[step] = i, j
        overlap[step] = (a_start[i] < ends_b) & (b_start[j] < ends_a) & (i < n_a) & (j < n_b)
        takes_a = ends_a <= ends_b
        closes[step] = ~takes_a & (a_start[i] == ends_b) & (j < n_b)
        going = (i < n_a) | (j < n_b)
        i += takes_a & going
        j += ~takes_a & going
    inside = (start + np.arange(steps)[:, None]) < n_a + n_b
    order = (overlap & inside).T
    shut = (closes & inside).T
    a, b = at_a.T, at_b.T
    return a[order], b[order], a[shut], b[shut] + 1


_DIGITS = 6
_POWERS = 10 ** np.arange(_DIGITS - 1, -1, -1)


def group_text(a_ids: np.ndarray, b_ids: np.ndarray, a_closes: np.ndarray, b_closes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes ``a1,a2|b1;a3|b2,b3;`` of all groups, and where each group's bytes end."""
    groups = np.arange(len(a_closes))
    a_group = np.repeat(groups, np.diff(a_closes, prepend=0))
    b_group = np.repeat(groups, np.diff(b_closes, prepend=0))
    place_a = np.arange(len(a_ids)) + np.append(0, b_closes[:-1])[a_group] if len(groups) else np.zeros(0, np.int64)
    place_b = np.arange(len(b_ids)) + a_closes[b_group]
    ids, mark = np.zeros((2, len(a_ids) + len(b_ids)), np.int64)
    ids[place_a], ids[place_b] = a_ids, b_ids
    mark[place_a], mark[place_b] = ord(","), ord(",")
    mark[place_a[a_closes - 1]], mark[place_b[b_closes - 1]] = ord("|"), ord(";")
    wide = np.maximum(1, np.searchsorted(_POWERS[::-1], ids, side="right"))
    after = np.cumsum(wide + 1)
    out = np.zeros(after[-1] if len(after) else 0, np.uint8)
    out[after - 1] = mark
    for k in range(_DIGITS):
        there = wide > k
        out[after[there] - 2 - k] = ord("0") + ids[there] // 10**k % 10
    return out, after[place_b[b_closes - 1]]


class Pair:
    """Two tokenizers: byte-level BPE (A) and pieces with byte fallback (B), with the bytes of every id."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        import tokenizers

        self._merge = tokenizers.Tokenizer.from_str(a_json).model.tokenize  # of one word, written as the file writes bytes
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        strings = Codec(a_json).strings
        self._split = regex.compile(SPLIT)
        self._written = {b: c for c, b in _printable_bytes().items()}
        self.a_bytes = [strings.get(i, b"") for i in range(max(strings) + 1)]
        names = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in names]
        self.a_length = np.array([len(b) for b in self.a_bytes])
        self.b_length = np.array([len(b) for b in self.b_bytes])

    def _a_ids(self, text: str) -> list[int]:
        """Special tokens' strings are plain text here: only words are looked up."""
        merge, written = self._merge, self._written
        return [t.id for w in self._split.findall(text) for t in merge(w.encode().decode("latin-1").translate(written))]

    def encode(self, texts: list[bytes]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of texts that begin with a space by A, and of what follows it by B, which puts a space there itself."""
        whole = [t.decode("utf-8", "replace") for t in texts]
        return [self._a_ids(t) for t in whole], self.b.encode([t[1:] for t in whole], num_threads=1) if whole else []

    def same(self, texts: list[bytes], a: list[list[int]], b: list[list[int]]) -> list[bool]:
        """Whether both tokenizers' bytes are those of each text."""
        sides = ((ids, own) for ids, own in ((a, self.a_bytes), (b, self.b_bytes)))
        made = [[b"".join(map(own.__getitem__, x)) for x in ids] for ids, own in sides]
        return [x == t == y for t, x, y in zip(texts, *made)]


@lru_cache(maxsize=1)
def _pair(a_json: str, b_model: bytes) -> Pair:
    return Pair(a_json, b_model)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum([0, *map(len, lists)])
    return np.fromiter(chain.from_iterable(lists), np.int64, ends[-1]), ends


class Chunk:
    """Documents of a chunk as stretches, and each different stretch with its alignment."""

    def __init__(self, pair: Pair, work: int = WORK):
        self.pair, self.work = pair, work
        self.number: dict[bytes, int] = {}  # of each different stretch; -1 if a tokenizer changes its bytes
        self.texts: list[bytes] = []  # its groups
        self.counts: list[np.ndarray] = []  # columns n_a, n_b, n_groups, n_links
        self.links: list[np.ndarray] = []  # A id and B id of each link, 32 bits each
        self.ids: list[np.ndarray] = []
        self.null: list[np.ndarray] = []
        self.used: list[np.ndarray] = []  # stretches of each document one after the other
        self.per_doc: list[np.ndarray] = []
        self.size = 0

    def _learn(self, new: list[bytes]) -> None:
        a, b = self.pair.encode(new)
        good = self.pair.same(new, a, b)
        kept = [k for k, g in enumerate(good) if g]
        for t, g in zip(new, good):
            if not g:
                self.number[t] = -1
        if not kept:
            return
        base = len(self.texts)
        self.number.update((new[k], base + n) for n, k in enumerate(kept))
        a_ids, a_at = _flat([a[k] for k in kept])
        b_ids, b_at = _flat([b[k] for k in kept])
        i, j, a_closes, b_closes = merge_path(np.cumsum(self.pair.a_length[a_ids]), np.cumsum(self.pair.b_length[b_ids]), self.work)
        text, ends = group_text(a_ids, b_ids, a_closes, b_closes)
        group_at = np.searchsorted(a_closes, a_at, side="right")  # a stretch ends with a group
        byte_at = np.append(0, ends)[group_at].tolist()
        raw = text.tobytes()
        self.texts += [raw[x:y] for x, y in zip(byte_at, byte_at[1:])]
        links = np.diff(np.searchsorted(i, a_at))
        self.counts.append(np.stack([np.diff(a_at), np.diff(b_at), np.diff(group_at), links], axis=1))
        self.links.append(a_ids[i] << 32 | b_ids[j])

    def add(self, ids: pa.Array, column: pa.Array) -> None:
        data, offsets = text_bytes(column)
        full = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][full], 0x20) if full.any() else data
        offsets = offsets + np.append(0, np.cumsum(full))
        start, row = space_cuts(data, offsets, after_space=False)
        coded = stretches(data, start).dictionary_encode()
        different = binary_list(coded.dictionary)
        self._learn([s for s in different if s not in self.number])
        which = np.array([self.number[s] for s in different], np.int64)[coded.indices.to_numpy()] if len(row) else np.zeros(0, np.int64)
        odd = np.unique(row[which < 0])
        if len(odd):  # encoded whole, or without tokens
            whole = [data[offsets[r] : offsets[r + 1]].tobytes() for r in odd]
            self._learn(list({w for w in whole if w not in self.number}))
            keep = ~np.isin(row, odd)
            number = np.array([self.number[w] for w in whole])
            row, which = np.append(row[keep], odd[number >= 0]), np.append(which[keep], number[number >= 0])
            order = np.argsort(row, kind="stable")
            row, which = row[order], which[order]
        self.ids.append(ids.fill_null(0).to_numpy())
        self.null.append(ids.is_null().to_numpy(zero_copy_only=False))
        self.used.append(which)
        self.per_doc.append(np.bincount(row, minlength=len(column)))
        self.size += len(which) + len(column)

    def documents(self) -> Iterator[list[int]]:
        used = np.concatenate(self.used).tolist()
        ends = np.cumsum(np.append(0, np.concatenate(self.per_doc))).tolist()
        return (used[x:y] for x, y in zip(ends, ends[1:]))

    def groups(self, stretches_: list[int]) -> bytes:
        return b"".join(map(self.texts.__getitem__, stretches_))[:-1]


_STATE = "chunk long, ids binary, null binary, per_doc binary, used_low binary, used_high binary, counts binary, links_low binary, links_high binary, digests binary, pairs binary, n binary"
_STATE_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def _planes(x: np.ndarray) -> tuple[bytes, bytes]:
    """Low and high 16 bits; the high ones are mostly zeros, which compress."""
    return (x & 0xFFFF).astype("<u2").tobytes(), (x >> 16).astype("<u2").tobytes()


def _joined(low, high) -> np.ndarray:
    return np.frombuffer(low, "<u2").astype(np.int64) | np.frombuffer(high, "<u2").astype(np.int64) << 16


def _state_row(number: int, c: Chunk) -> pa.RecordBatch:
    used, per_doc = np.concatenate(c.used), np.concatenate(c.per_doc)
    counts = np.concatenate(c.counts) if c.counts else np.zeros((0, 4), np.int64)
    links = np.concatenate(c.links) if c.links else np.zeros(0, np.int64)
    pairs, place = np.unique(links, return_inverse=True)
    times = np.bincount(used, minlength=len(counts))
    n = np.bincount(place, weights=np.repeat(times, counts[:, 3]), minlength=len(pairs)).astype(np.int64)
    digests = b"".join(hashlib.sha256(c.groups(d)).digest() if d else bytes(32) for d in c.documents())
    row = [
        number, np.concatenate(c.ids).tobytes(), np.concatenate(c.null).tobytes(), per_doc.astype("<u4").tobytes(), *_planes(used),
        counts.astype("<u4").tobytes(), *_planes(place), digests, pairs.tobytes(), n.tobytes(),
    ]
    kinds = [pa.int64(), *[pa.binary()] * (len(row) - 1)]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=_STATE_NAMES)


def chunks(docs: DataFrame, a_json: str, b_model: bytes, chunk_stretches: int = CHUNK_STRETCHES) -> DataFrame:
    """One row for each chunk of (doc_id, text); written once, since all later steps read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, part, number = _pair(a_json, b_model), TaskContext.get().partitionId(), 0
        chunk = Chunk(pair)
        for batch in pieces(batches):
            chunk.add(batch.column(0), batch.column(1))
            if chunk.size >= chunk_stretches:
                yield _state_row(part << 24 | number, chunk)
                chunk, number = Chunk(pair), number + 1
        if chunk.ids:
            yield _state_row(part << 24 | number, chunk)
        del chunk
        give_back()

    coded = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _STATE)
    return materialize(coded, CHUNKS_PER_FILE)


def _asked(state: DataFrame) -> DataFrame:
    """(chunk, place, a, b, n) of every different pair of every chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                code, n = np.frombuffer(pairs.as_buffer(), np.int64), np.frombuffer(n.as_buffer(), np.int64)
                for at in range(0, len(code), 50_000):
                    c, m = code[at : at + 50_000], n[at : at + 50_000]
                    place = np.arange(at, at + len(c), dtype=np.int32)
                    columns = [np.full(len(c), chunk), place, (c >> 32).astype(np.int32), (c & 0xFFFFFFFF).astype(np.int32), m]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["chunk", "place", "a", "b", "n"])

    return state.select("chunk", "pairs", "n").mapInArrow(run, "chunk long, place int, a int, b int, n long")


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finish(state: pa.Table, answers: pa.Table) -> pa.Table:
    """Every document's sums over its stretches, with the corpus counts of the chunk's pairs."""
    r = {name: state.column(name)[0] for name in _STATE_NAMES}
    read = {name: v.as_buffer() for name, v in r.items() if name != "chunk"}
    ids, null = np.frombuffer(read["ids"], np.int64), np.frombuffer(read["null"], bool)
    per_doc = np.frombuffer(read["per_doc"], "<u4").astype(np.int64)
    used, place = _joined(read["used_low"], read["used_high"]), _joined(read["links_low"], read["links_high"])
    counts = np.frombuffer(read["counts"], "<u4").astype(np.int64).reshape(-1, 4)
    n, best = np.zeros((2, len(read["pairs"]) // 8), np.int64)
    at = answers.column("place").to_numpy()
    n[at], best[at] = answers.column("total").to_numpy(), answers.column("best").to_numpy()
    link_at = np.append(0, np.cumsum(counts[:, 3]))
    total = [np.append(0, np.cumsum(x[place]))[link_at] for x in (best, n)]
    own = np.column_stack([counts, *(np.diff(t) for t in total)])
    doc_at = np.append(0, np.cumsum(per_doc))
    sums = [np.append(0, np.cumsum(own[used, k]))[doc_at] for k in range(own.shape[1])]
    digests = bytes(read["digests"])
    texts = [digests[32 * k : 32 * k + 32].hex() if d else "" for k, d in enumerate(per_doc.tolist())]
    columns = [pa.array(ids, mask=null), *(pa.array(np.diff(s)) for s in sums), pa.array(texts, pa.string())]
    return pa.Table.from_arrays(columns, names=[f.split()[0] for f in _RESULT.split(", ")])


def align(docs: DataFrame, a_json: str, b_model: bytes, chunk_stretches: int = CHUNK_STRETCHES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of (doc_id, text).

    ``count_sum`` adds up the corpus-wide counts of the row's linked id pairs, ``n_best`` says for how many links that
    count is the highest of their B id.
    """
    state = chunks(docs, a_json, b_model, chunk_stretches)
    asked = _asked(state)
    counted = materialize(asked.groupBy("a", "b").agg(F.sum("n").alias("total")))
    most = counted.groupBy("b").agg(F.max("total").alias("most"))  # a row for each id of B's vocabulary at most
    known = counted.join(F.broadcast(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    answers = asked.select("chunk", "place", "a", "b").join(known, ["a", "b"]).select("chunk", "place", "total", "best")
    return state.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish, _RESULT)


def pair_counts(docs: DataFrame, a_json: str, b_model: bytes, chunk_stretches: int = CHUNK_STRETCHES) -> DataFrame:
    """(a, b, n): how many links of the corpus hold the pair of ids."""
    return _asked(chunks(docs, a_json, b_model, chunk_stretches)).where("n > 0").groupBy("a", "b").agg(F.sum("n").alias("n"))


def groups(docs: DataFrame, a_json: str, b_model: bytes, text: str = "text", out: str = "groups") -> DataFrame:
    """``docs`` with every text's groups as ``a1,a2|b1;a3|b2,b3``."""
    schema = T.StructType([*(f for f in docs.schema if f.name != out), T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_json, b_model)
        for batch in pieces(batches, text):
            c = Chunk(pair)
            c.add(pa.array(np.arange(batch.num_rows)), batch.column(batch.schema.get_field_index(text)))
            made = pa.array([c.groups(d).decode() for d in c.documents()], pa.string())
            kept = [i for i, n in enumerate(batch.schema.names) if n != out]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), made], names=schema.names)

    return docs.mapInArrow(run, schema)


def vocabulary_files(a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> tuple[str, bytes]:
    """Contents of two public vocabulary files, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(a), encoding="utf-8") as f, open(public_tokenizers.path(b), "rb") as g:
        return f.read(), g.read()


@query("op13_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, links and corpus-wide link counts of two vocabularies over every whole document."""
    return align(table(spark, sf_dir, "documents"), *vocabulary_files())
