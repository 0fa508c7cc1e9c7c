"""Byte-level BPE: merges by a priority queue over a doubly linked symbol list; decoding by vocabulary strings.

Texts are encoded where they lie, in Arrow batches; nothing is shuffled.  The vocabulary
file is read once on the driver, and its text (fixed size, about 1.5 MB) goes with the tasks.

Defined results: null text is empty; empty text has no ids; null ids decode to null; extra
columns are kept, but one named like the output column is replaced.  Long texts are encoded
whole: a word of n bytes takes O(n log n).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riffle.llm.common import give_back, pieces, table
from riffle.llm.registry import query

#: How byte-level vocabularies split a text before merging (fixed value of the file format).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept encoded by each Python worker; a memory, not a limit.
MEMORY = 1 << 18


def _printable_bytes() -> dict[str, int]:
    """The file writes each byte as one visible character: itself if visible in Latin-1, else 256 and up in order."""
    shown = [b for b in range(256) if unicodedata.category(chr(b))[0] in "LNPS" and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Tables of one vocabulary file, and the words encoded so far."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, byte_of = spec["model"], _printable_bytes()
        ids = model["vocab"]
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s.encode() for s, i in self.special.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        #: left id and right id to rank and merged id, 20 bits for an id; rank 0 counts as 1, so that no entry is 0
        self.merges = {(ids[a] << 20) + ids[b]: (rank << 20) + ids[a + b] for rank, (a, b) in enumerate(pairs, 1)}
        self.of_byte = [ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        self.split = regex.compile(SPLIT)
        self.at_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        #: A space inside a run of white space, where words can't be encoded one by one.
        self.in_run = regex.compile(r"\s (?=\s|\Z)")
        self.word_ids: dict[str, bytes] = {}
        self.chunk_ids = _Chunks(self)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank first, the leftmost of equals; entries that no longer fit are skipped."""
        symbol = list(map(self.of_byte.__getitem__, data))
        n, find, push, pop = len(symbol), self.merges.get, heapq.heappush, heapq.heappop
        symbol.append(-1)  # stands right of the last and left of the first symbol, and for merged ones: in no pair
        right, left = list(range(1, n + 2)), list(range(-1, n))
        queue = [(hit << 32) + i for i in range(n - 1) if (hit := find((symbol[i] << 20) + symbol[i + 1]))]
        heapq.heapify(queue)
        while queue:
            entry = pop(queue)
            i, hit = entry & 0xFFFFFFFF, entry >> 32
            j = right[i]
            if find((symbol[i] << 20) + symbol[j]) != hit:
                continue
            made = symbol[i] = hit & 0xFFFFF
            symbol[j] = -1
            j = right[i] = right[j]
            k = left[i]
            left[j] = i
            if hit := find((made << 20) + symbol[j]):
                push(queue, (hit << 32) + i)
            if hit := find((symbol[k] << 20) + made):
                push(queue, (hit << 32) + k)
        return [s for s in symbol if s >= 0]

    def encode_split(self, text: str) -> bytes:
        """Int32 ids of a text cut by SPLIT."""
        out = []
        for word in self.split.findall(text):
            ids = self.word_ids.get(word)
            if ids is None:
                if len(self.word_ids) >= MEMORY:
                    self.word_ids.clear()
                ids = array("i", self.merge(word.encode())).tobytes()
                if len(word) <= 64:
                    self.word_ids[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode_plain(self, text: str) -> bytes:
        """The same, with what stands between single spaces encoded once: SPLIT never joins text across such a space."""
        if self.in_run.search(text):
            return self.encode_split(text)
        first, *rest = text.split(" ")
        return self.encode_split(first) + b"".join(map(self.chunk_ids.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [self.encode_plain(text[at : m.start()]), np.int32(self.special[m[0]]).tobytes()]
            at = m.end()
        return b"".join([*out, self.encode_plain(text[at:])])

    def forget(self) -> None:
        self.word_ids.clear()
        self.chunk_ids.clear()

    def decode(self, ids) -> str:
        """Vocabulary strings one after the other; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


class _Chunks(dict):
    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= MEMORY:
            self.clear()
        ids = self.codec.encode_split(" " + chunk)
        if len(chunk) <= 64:
            self[chunk] = ids
        return ids


@lru_cache(maxsize=2)
def codec(text: str) -> Codec:
    return Codec(text)


def _with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [i for i, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(i) for i in kept), values], names=[*(batch.schema.names[i] for i in kept), name]
    )


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*(f for f in df.schema if f.name != name), T.StructField(name, kind)])


def _encoder(vocabulary: str, text: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in pieces(batches, text):
            blobs = [own.encode(t or "") for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(blobs), dtype=np.int32), type=pa.int32())
            yield _with_column(batch, out, pa.ListArray.from_arrays(pa.array(ends), ids))
        own.forget()  # the worker lives on and may run other stages
        give_back()

    return run


def _decoder(vocabulary: str, ids: str, out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = part.column(part.schema.get_field_index(ids))
                texts = [None if r is None else own.decode(r) for r in (x.values.tolist() if x.is_valid else None for x in _arrays(rows))]
                yield _with_column(part, out, pa.array(texts, type=pa.string()))
        give_back()

    return run


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of each whole text as array<int>."""
    return df.mapInArrow(_encoder(vocabulary, text, out), _schema(df, out, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that each array of ids stands for."""
    return df.mapInArrow(_decoder(vocabulary, ids, out), _schema(df, out, T.StringType()))


def encode_decode(df: DataFrame, vocabulary: str, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df``, ids and decoded, as ``decode(encode(df))`` gives them.

    One Python worker a task does both: ids do not travel to Spark and back, and tables are held once.
    """
    coder, back = _encoder(vocabulary, text, "ids"), _decoder(vocabulary, "ids", "decoded")
    made = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*(df.schema[c] for c in keep), *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in back(coder(batches)):
            yield batch.select(schema.names)

    return df.mapInArrow(run, schema)


class _Row:
    def __init__(self, values, is_valid):
        self.values, self.is_valid = values, is_valid


def _arrays(rows: pa.ListArray) -> Iterator[_Row]:
    flat = np.asarray(rows.values)
    ends = np.asarray(rows.offsets)
    for i, valid in enumerate(rows.is_valid().to_pylist()):
        yield _Row(flat[ends[i] : ends[i + 1]], valid)


def vocabulary_text(name: str = "byte_bpe_50k.json") -> str:
    """Text of a public vocabulary file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


@query("op10_bpe_tokens")
def bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document and their decoded text, as digests."""
    words = vocabulary_text()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_decode(docs, words, ["doc_id"]).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
