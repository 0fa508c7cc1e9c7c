"""Byte-level BPE by prefix dynamic programming: each byte prefix stores its unique valid last token.

Two neighbouring tokens fit if merging their joined bytes gives just these two.  An encoding is that of the
merges exactly if all neighbours fit, for merges across a border would show in the pair beside it.  So the
last token of a prefix is the one token that ends there and fits the last token of what stands before it,
and the encoding is read backwards from the end.  Prefixes do not change when bytes are appended: words are encoded
in sorted order, each from where it leaves the one before it.  After an edit the table is rebuilt only until as
many entries in a row agree with the old ones as the longest token has bytes.

Texts are encoded where they lie, in Arrow batches, nothing is shuffled.  Batches are cut before spaces where the
pattern always cuts, and each different stretch is encoded once.  The rank file's text (fixed size, under 1 MB)
goes with the tasks.

Defined results: null text is empty; empty text has no ids and decodes to no bytes; null ids decode to null, and
ids that the file does not have are an error; extra columns are kept, but one named like the output column is
replaced.  Long texts are encoded whole; a word of n bytes takes n steps of at most as many lookups as there are token lengths.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riffle.llm.common import binary_list, give_back, pieces, space_cuts, stretches, table, text_bytes
from riffle.llm.registry import query

#: Stretches, and pairs of tokens, kept by each Python worker; a memory, not a limit.
MEMORY = 1 << 19


class Ranks:
    """Tokens of one rank file: bytes to rank, which is also the id.

    What ends at a place is found by stepping from state to state: a state is the longest stretch before the place
    that some token begins with, and lists the tokens among its ends.  States and steps are made when first met.
    """

    def __init__(self, text: str):
        rows = (line.split() for line in text.splitlines() if line.strip())
        self.ids = {base64.b64decode(token): int(rank) for token, rank in rows}
        if any(bytes([b]) not in self.ids for b in range(256)):
            raise ValueError("a rank file needs all 256 bytes")
        self.bytes_of = {i: token for token, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        #: every beginning of a token, numbered when it becomes a state; the empty one is state 0
        self._state: dict[bytes, int] = {token[:n]: -1 for token in self.ids for n in range(1, len(token) + 1)}
        self._stretch = [b""]
        #: tokens that end in a state as (length, id), longest first
        self.ending: list[list[tuple[int, int]]] = [[]]
        self.steps: dict[int, int] = {}
        self.fitting: dict[int, bool] = {}
        self._histories: dict[int, tuple | None] = {}

    def step(self, state: int, byte: int) -> int:
        """The state after one more byte."""
        if len(self.steps) >= MEMORY:
            self.steps.clear()
        stretch = self._stretch[state] + bytes([byte])
        while stretch not in self._state:  # ends at the latest with the byte alone, which is a token
            stretch = stretch[1:]
        number = self._state[stretch]
        if number < 0:
            number = self._state[stretch] = len(self._stretch)
            self._stretch.append(stretch)
            ends = (stretch[i:] for i in range(len(stretch)))
            self.ending.append([(len(e), self.ids[e]) for e in ends if e in self.ids])
        self.steps[state << 8 | byte] = number
        return number

    def merge(self, data: bytes, seen: list[tuple[int, bytes, bytes]] | None = None) -> list[int]:
        """Ids by the definition: lowest rank first, leftmost of equals.  For few bytes.

        ``seen`` gets every merge's rank, and the first and the last part after it.
        """
        none, find = 1 << 62, self.ids.get
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [find(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks and (lowest := min(ranks)) < none:
            i = ranks.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = find(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = find(parts[i] + parts[i + 1], none)
            if seen is not None:
                seen.append((lowest, parts[0], parts[-1]))
        return [self.ids[p] for p in parts]

    def history(self, token: int) -> tuple | None:
        """Ranks, first parts and last parts of a token's own merges in order; None if they don't end in the token."""
        if token not in self._histories:
            seen, data = [], self.bytes_of[token]
            whole = self.merge(data, seen) == [token]
            columns = tuple(zip(*seen)) or ((), (), ())
            self._histories[token] = (columns[0], (data[:1], *columns[1]), (data[-1:], *columns[2])) if whole else None
        return self._histories[token]

    def _apart(self, before: int, token: int) -> bool:
        """Whether merging the joined bytes never merges across the border: both histories run side by side."""
        left, right = self.history(before), self.history(token)
        if left is None or right is None:
            return False
        (a_ranks, _, a_parts), (b_ranks, b_parts, _), none, find = left, right, 1 << 62, self.ids.get
        a_ranks, b_ranks, i, j = (*a_ranks, none), (*b_ranks, none), 0, 0
        while True:
            a, b, across = a_ranks[i], b_ranks[j], find(a_parts[i] + b_parts[j], none)
            if across < a and across <= b:  # of equal ranks the leftmost merges first
                return False
            if a <= b:
                if a == none:
                    return True
                i += 1
            else:
                j += 1

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: nothing)."""
        if len(self.fitting) >= MEMORY:
            self.fitting.clear()
        known = self.fitting[(before << 32) + token] = self.history(token) is not None if before < 0 else self._apart(before, token)
        return known


class Prefixes:
    """A byte string, and the last token and the state of each of its prefixes."""

    def __init__(self, ranks: Ranks, data: bytes = b""):
        self.ranks, self.data = ranks, b""
        #: last token of the prefix of each length; -1 for the empty one
        self.last: list[int] = [-1]
        self._states = [0]
        self.append(data)

    def append(self, data: bytes) -> None:
        """Exact: entries so far stay."""
        ranks, last, states = self.ranks, self.last, self._states
        step, ending, known = ranks.steps.get, ranks.ending, ranks.fitting.get
        state = states[-1]
        for byte in data:
            after = step(state << 8 | byte)
            state = ranks.step(state, byte) if after is None else after
            for n, token in ending[state]:
                before = last[-n]
                fit = known((before << 32) + token)
                if fit or (fit is None and ranks.fits(before, token)):
                    break
            last.append(token)
            states.append(state)
        self.data += data

    def become(self, data: bytes) -> None:
        """Another byte string: what it has in common with this one at the start is kept."""
        common = 0
        for a, b in zip(self.data, data):
            if a != b:
                break
            common += 1
        self.cut(common)
        self.append(data[common:])

    def cut(self, length: int) -> None:
        """Keep only the first ``length`` bytes."""
        self.data = self.data[:length]
        del self.last[length + 1 :], self._states[length + 1 :]

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from ``start`` to ``end``; returns how many entries were computed."""
        tail, old, states = self.data[end:], self.last[end + 1 :], self._states[end + 1 :]
        self.cut(start)
        self.append(new)
        same, made, near = 0, len(new), self.ranks.longest
        for at in range(0, len(tail), near):
            part = tail[at : at + near]
            self.append(part)
            made += len(part)
            for i in range(at, at + len(part)):
                same = same + 1 if self.last[len(new) + start + 1 + i] == old[i] else 0
            if same >= near:  # all that later entries look at is as it was
                after = at + len(part)
                self.data += tail[after:]
                self.last += old[after:]
                self._states += states[after:]
                break
        return made

    def ids(self) -> list[int]:
        out, end, last, tokens = [], len(self.data), self.last, self.ranks.bytes_of
        while end:
            token = last[end]
            out.append(token)
            end -= len(tokens[token])
        out.reverse()
        return out


class Encoder:
    """Encodes texts cut by a pattern, and remembers stretches."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.stretch_ids: dict[bytes, bytes] = {}

    def words(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Int32 ids of each word.  A word that is a token is that token."""
        out, find = {}, self.ranks.ids.get
        prefixes = Prefixes(self.ranks)
        for word in sorted(words):
            token = find(word)
            if token is not None:
                out[word] = array("i", [token]).tobytes()
                continue
            prefixes.become(word)
            out[word] = array("i", prefixes.ids()).tobytes()
        return out

    def cut_words(self, stretch: bytes) -> list[bytes]:
        return [w.encode() for w in self.pattern.findall(stretch.decode("utf-8", "replace"))]

    def stretch_list(self, different: list[bytes]) -> list[bytes]:
        """Int32 ids of every stretch."""
        known = self.stretch_ids
        if len(known) >= MEMORY:
            known.clear()
        cut = {s: self.cut_words(s) for s in different if s not in known}
        made = self.words({w for words in cut.values() for w in words})
        fresh = {s: made[words[0]] if len(words) == 1 else b"".join([made[w] for w in words]) for s, words in cut.items()}
        out = [fresh[s] if s in fresh else known[s] for s in different]
        known.update((s, ids) for s, ids in fresh.items() if len(s) <= 64)
        return out

    def encode(self, column: pa.Array) -> list[bytes]:
        """Int32 ids of every text."""
        data, offsets = text_bytes(column)
        start, row = space_cuts(data, offsets)
        coded = stretches(data, start).dictionary_encode()
        ids = self.stretch_list(binary_list(coded.dictionary))
        which = coded.indices.to_numpy().tolist()
        first = np.searchsorted(row, np.arange(len(column) + 1)).tolist()
        return [b"".join(map(ids.__getitem__, which[a:b])) for a, b in zip(first, first[1:])]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.ranks.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(ranks: str, pattern: str) -> Encoder:
    return Encoder(Ranks(ranks), pattern)


Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), values], names=[*(batch.schema.names[i] for i in kept), name])


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema if f.name != name), T.StructField(name, kind)])


def encoding(ranks: str, pattern: str, text: str = "text", out: str = "ids") -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in pieces(batches, text):
            blobs = own.encode(batch.column(batch.schema.get_field_index(text)))
            ends = np.cumsum([0, *(len(b) // 4 for b in blobs)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(blobs), dtype=np.int32))
            yield _with_column(batch, out, pa.ListArray.from_arrays(pa.array(ends), ids))
        give_back()

    return run


def decoding(ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> Step:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            made = [own.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in column]
            yield _with_column(batch, out, pa.array(made, type=pa.binary()))

    return run


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text as array<int>."""
    return df.mapInArrow(encoding(ranks, pattern, text, out), _schema(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each array of ids stands for, as binary: they need not be whole characters."""
    return df.mapInArrow(decoding(ranks, pattern, ids, out), _schema(df, out, T.BinaryType()))


def digests(df: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows (doc_id, text): encoded, decoded and hashed in one worker a task."""
    coder, back = encoding(ranks, pattern), decoding(ranks, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in back(coder(batches)):
            ids, decoded = batch.column(2), batch.column(3)
            raw = [x.values.to_numpy().astype("<u4").tobytes() for x in ids]
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in raw], type=pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in raw], type=pa.string()),
                pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in decoded], type=pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    made = T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields
    return df.select("doc_id", "text").mapInArrow(run, T.StructType([df.schema["doc_id"], *made]))


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Text of a public rank file and the pattern that goes with it, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="ascii") as f:
        return f.read(), public_tokenizers.PATTERN


@query("op12_prefix_bpe_tokens")
def prefix_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and their decoded bytes, as digests."""
    return digests(table(spark, sf_dir, "documents"), *rank_file())
