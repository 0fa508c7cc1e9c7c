"""Word bigram scores from a sharded Elias-Fano trie.

P(w | v) = max(c(v w) - D, 0) / c(v) + D * kinds(v) / c(v) * P1(w), with P1(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)): absolute
discounting over the smoothed unigram.  Counts come from all training documents; every document is scored.  The first term is
what the trie stores, in 16 bits, to 0.03 % of its value.

The corpus is cut to chunks of about ``CHUNK_TOKENS`` tokens.  A chunk asks for each different word and word
pair once: a request names the pair and how often the chunk's training documents hold it.  A shard adds up
the requests for its pairs, builds the trie (see ``eliasfano``) with quantised counts and answers all chunks; so counting
and scoring take one shuffle.  Words very common as contexts are split over all shards by the next word.  Shards grow in number,
not in size, with the corpus.  Trie values are counts, since the total of a split context is known only
after all shards; discount and division follow when the answers meet their chunk.

Words are 64-bit hashes; within a context, the next word is known by 40 bits of its hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import give_back, id_remainder, materialize, mix64, pieces, table, text_bytes, word_table
from riffle.llm.eliasfano import Trie
from riffle.llm.registry import query

CHUNK_TOKENS = 2_000_000
SHARD_TOKENS = 2_000_000
SUCCESSOR_BITS = 40
END, START = (int(x) for x in mix64(np.array([1, 2], dtype=np.uint64)))
DISCOUNT = 0.75
#: Between two codes of a probability; the smallest one that has a code is 1e-14.
_STEP = 14 * np.log(10) / 65534
_ROW = "chunk long, kind int, shard int, n long, a binary, b binary, c binary, d binary, e binary, f binary"
_NAMES = [f.split()[0] for f in _ROW.split(", ")]
_STATE, _WORDS, _PAIRS, _KINDS, _TOTALS = range(5)


def quantise(p: np.ndarray) -> np.ndarray:
    """16-bit code of a probability above 0; code 0 stands for none."""
    return np.clip(1 + np.rint(-np.log(p) / _STEP), 1, 65535).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return np.where(code > 0, np.exp((1.0 - code.astype(np.float64)) * _STEP), 0.0)


def _shard(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_NAMES)
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
    packed = [[x.tobytes() if isinstance(x, np.ndarray) else x for x in c] for c in columns]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(packed, kinds)], names=_NAMES)


def _records(rows: pa.Table | pa.RecordBatch) -> Iterator[dict]:
    """Rows as dictionaries whose binary values are views, not copies."""
    for i in range(rows.num_rows):
        cells = ((name, rows.column(k)[i]) for k, name in enumerate(rows.schema.names))
        yield {name: None if not x.is_valid else x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.as_py() for name, x in cells}


def _planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and high 16 bits; the high ones are mostly zeros, which compress."""
    return (x & 0xFFFF).astype("<u2"), (x >> 16).astype("<u2")


def _joined(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u2").astype(np.int64) | np.frombuffer(high, "<u2").astype(np.int64) << 16


class Chunk:
    """Documents of a chunk: ids, flags (1 trains, 2 held out, 4 id is null), token ends, different words by falling count with START last, tokens as places among them."""

    def __init__(self, ids: np.ndarray, flags: np.ndarray, ends: np.ndarray, words: np.ndarray, tokens: np.ndarray):
        self.ids, self.flags, self.ends, self.words, self.tokens = ids, flags, ends, words, tokens

    @classmethod
    def of(cls, ids, flags, ends, hashes):
        words, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return cls(ids, flags, ends, np.append(words[order], np.uint64(START)), place[which])

    def row(self, number: int) -> tuple:
        return (number, _STATE, 0, len(self.tokens), self.ids, self.flags, self.ends.astype("<i4"), self.words, *_planes(self.tokens))

    @classmethod
    def from_row(cls, r: dict):
        return cls(np.frombuffer(r["a"], np.int64), np.frombuffer(r["b"], np.uint8), np.frombuffer(r["c"], "<i4").astype(np.int64), np.frombuffer(r["d"], np.uint64), _joined(r["e"], r["f"]))

    @property
    def trains(self) -> np.ndarray:
        return np.repeat((self.flags & 1).astype(bool), np.diff(np.append(0, self.ends)))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different pairs as places (context, word), in order; which one each token ends; how often training documents hold it."""
        n = len(self.words)
        before = np.append(n - 1, self.tokens[:-1])
        before[self.ends[:-1]] = n - 1
        codes, which = np.unique(before * n + self.tokens, return_inverse=True)
        return codes // n, codes % n, which, np.bincount(which[self.trains], minlength=len(codes))

    def pair_shards(self, context: np.ndarray, word: np.ndarray, shards: int, hot: np.ndarray) -> np.ndarray:
        h = mix64(self.words ^ np.uint64(END))
        home = h[context]
        split = np.isin(self.words, hot)[context]
        home = np.where(split, mix64(home ^ self.words[word]), home)
        return _shard(home, shards)


def chunks(docs: DataFrame, trains: Column, held: Column, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """One row for each chunk of (doc_id, text); written once, since all later steps read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        held_: list[tuple] = []
        for batch in pieces(batches):
            data, offsets = text_bytes(batch.column(1))
            row, _, _, hashes = word_table(data, offsets)
            n = np.bincount(row, minlength=batch.num_rows)
            ends = np.cumsum(n + 1)
            tokens = np.full(ends[-1], END, dtype=np.uint64)
            tokens[np.arange(len(hashes)) + row] = hashes
            none = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            flags = batch.column(2).to_numpy().astype(np.uint8) | none.astype(np.uint8) << 2
            held_.append((batch.column(0).fill_null(0).to_numpy(), flags, n + 1, tokens))
            size += len(tokens)
            if size >= chunk_tokens:
                yield _rows([_chunk(held_).row(part << 24 | number)])
                held_, number, size = [], number + 1, 0
        if held_:
            yield _rows([_chunk(held_).row(part << 24 | number)])

    flags = F.coalesce(trains, F.lit(False)).cast("int") + 2 * F.coalesce(held, F.lit(False)).cast("int")
    return materialize(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), flags.alias("flags")).mapInArrow(run, _ROW))


def _chunk(held: list[tuple]) -> Chunk:
    ids, flags, n, tokens = (np.concatenate(x) for x in zip(*held))
    return Chunk.of(ids, flags, np.cumsum(n), tokens)


def _each(frame: DataFrame, f) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _records(batch):
                for rows in f(r):
                    yield _rows(rows)
        give_back()

    return frame.mapInArrow(run, _ROW)


def _common_words(state: DataFrame, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with over a quarter of a shard's share of all tokens, at most 4 * shards of them, and START; and their counts as training contexts."""

    def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in _records(batch):
                c = Chunk.from_row(r)
                n = np.bincount(c.tokens, minlength=len(c.words))
                many = np.flatnonzero(n * 8 * shards > len(c.tokens))
                yield pa.RecordBatch.from_arrays([pa.array(c.words[many].view(np.int64)), pa.array(n[many])], names=["word", "n"])

    total = state.agg(F.sum("n")).first()[0] or 0
    counted = state.mapInArrow(often, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * 4 * shards > total)
    hot = np.array(sorted({*(r.word for r in counted.collect()), np.uint64(START).astype(np.int64)}), dtype=np.int64).view(np.uint64)
    hot = np.sort(hot)

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(hot), np.int64)
        for batch in batches:
            for r in _records(batch):
                c = Chunk.from_row(r)
                own = np.bincount(c.tokens[c.trains], minlength=len(c.words))
                own[-1] = np.count_nonzero(c.flags & 1)  # START stands before the first token of each text
                at = np.minimum(np.searchsorted(hot, c.words), len(hot) - 1)
                same = hot[at] == c.words
                n[at[same]] += own[same]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(hot))), pa.array(n)], names=["at", "n"])

    counts = np.zeros(len(hot), np.int64)
    for r in state.mapInArrow(trained, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r.at] = r.n
    return hot, counts


def _ask_words(shards: int):
    def ask(r: dict):
        c = Chunk.from_row(r)
        count = np.bincount(c.tokens[c.trains], minlength=len(c.words))
        home = _shard(c.words, shards)
        order = np.argsort(home, kind="stable")
        at = np.searchsorted(home[order], np.arange(shards + 1))
        yield [(r["chunk"], _WORDS, s, 0, c.words[o := order[at[s] : at[s + 1]]], *_planes(count[o]), None, None, None) for s in range(shards) if at[s] < at[s + 1]]

    return ask


def _ask_pairs(shards: int, hot: np.ndarray):
    def ask(r: dict):
        c = Chunk.from_row(r)
        context, word, _, count = c.pairs()
        home = c.pair_shards(context, word, shards, hot)
        order = np.argsort(home, kind="stable")
        at = np.searchsorted(home[order], np.arange(shards + 1))
        rows = []
        for s in range(shards):
            o = order[at[s] : at[s + 1]]
            if len(o):
                first = np.flatnonzero(np.append(True, context[o][1:] != context[o][:-1]))
                runs = np.diff(np.append(first, len(o)))
                successors = (c.words[word[o]] >> np.uint64(64 - SUCCESSOR_BITS)).view(np.uint8).reshape(-1, 8)[:, : SUCCESSOR_BITS // 8]
                rows.append((r["chunk"], _PAIRS, s, 0, c.words[context[o][first]], runs.astype("<u4"), np.ascontiguousarray(successors), *_planes(count[o]), None))
            if len(rows) == 64:
                yield rows
                rows = []
        yield rows

    return ask


def _answer_pairs(shards: int, hot: np.ndarray, hot_counts: np.ndarray, discount: float):
    def run(group: pa.Table) -> pa.Table:
        asked = []
        for r in _records(group):
            raw = np.frombuffer(r["c"], np.uint8).reshape(-1, SUCCESSOR_BITS // 8)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, : raw.shape[1]] = raw
            asked.append((r["chunk"], r["shard"], np.frombuffer(r["a"], np.uint64), np.frombuffer(r["b"], "<u4"), wide.view(np.uint64).ravel(), _joined(r["d"], r["e"])))
        context = np.concatenate([np.repeat(a[2], a[3])[a[5] > 0] for a in asked])
        successor = np.concatenate([a[4][a[5] > 0] for a in asked])
        count = np.concatenate([a[5][a[5] > 0] for a in asked])
        order = np.lexsort((successor, context))
        context, successor, count = context[order], successor[order], count[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (context[1:] != context[:-1]) | (successor[1:] != successor[:-1])
        at = np.flatnonzero(new)
        context, successor = context[at], successor[at]
        count = np.add.reduceat(count, at) if len(at) else count
        first = np.flatnonzero(np.append(True, context[1:] != context[:-1])) if len(at) else at
        known, total = context[first], np.add.reduceat(count, first) if len(at) else count
        place = np.minimum(np.searchsorted(hot, known), len(hot) - 1)
        total = np.where(hot[place] == known, hot_counts[place], total)  # of a split context, not all pairs are here
        p = (count - discount) / np.repeat(total, np.diff(np.append(first, len(at))))
        trie = Trie(context, successor, quantise(p), SUCCESSOR_BITS)
        rows = [(chunk, _PAIRS, shard, 0, trie.lookup(c, runs, s), None, None, None, None, None) for chunk, shard, c, runs, s, _ in asked]
        words, kinds = trie.degrees()
        home = _shard(words, shards)
        for s in np.unique(home):
            own = home == s
            rows.append((-1, _KINDS, int(s), 0, words[own], *_planes(kinds[own]), None, None, None))
        return pa.Table.from_batches([_rows(rows)])

    return run


def _answer_words(group: pa.Table) -> pa.Table:
    asked = [(r["chunk"], r["kind"], r["shard"], np.frombuffer(r["a"], np.uint64), _joined(r["b"], r["c"])) for r in _records(group)]
    words, which = np.unique(np.concatenate([a[3] for a in asked]), return_inverse=True)
    value = np.concatenate([a[4] for a in asked])
    kind = np.repeat([a[1] for a in asked], [len(a[3]) for a in asked])
    count, kinds = (np.bincount(which[kind == k], weights=value[kind == k], minlength=len(words)).astype(np.int64) for k in (_WORDS, _KINDS))
    rows, at = [], 0
    for chunk, k, shard, own, _ in asked:
        if k == _WORDS:
            place = which[at : at + len(own)]
            rows.append((chunk, _WORDS, shard, 0, count[place], kinds[place], None, None, None, None))
        at += len(own)
    rows.append((-1, _TOTALS, int(np.sum(count > 0)), int(count.sum()), *[None] * 6))
    return pa.Table.from_batches([_rows(rows)])


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _finish(shards: int, hot: np.ndarray, train_tokens: int, kinds_seen: int, discount: float):
    def run(group: pa.Table) -> pa.Table:
        rows = list(_records(group))
        c = Chunk.from_row(next(r for r in rows if r["kind"] == _STATE))
        context, word, which, _ = c.pairs()
        count, kinds = np.zeros((2, len(c.words)), np.int64)
        code = np.zeros(len(context), np.uint16)
        places = {_WORDS: _shard(c.words, shards), _PAIRS: c.pair_shards(context, word, shards, hot)}
        order = {k: np.argsort(v, kind="stable") for k, v in places.items()}
        at = {k: np.searchsorted(v[order[k]], np.arange(shards + 1)) for k, v in places.items()}
        for r in rows:
            if r["kind"] != _STATE:
                own = order[r["kind"]][at[r["kind"]][r["shard"]] : at[r["kind"]][r["shard"] + 1]]
                if r["kind"] == _WORDS:
                    count[own], kinds[own] = np.frombuffer(r["a"], np.int64), np.frombuffer(r["b"], np.int64)
                else:
                    code[own] = np.frombuffer(r["a"], np.uint16)
        single = (count + 0.5) / (train_tokens + 0.5 * (kinds_seen + 1))
        total = count.astype(np.float64)
        total[-1] = count[:-1][c.words[:-1] == np.uint64(END)].sum()  # as often as texts begin, they end
        safe = np.maximum(total, 1)
        p = np.where(total[context] > 0, restored(code) + discount * kinds[context] / safe[context] * single[word], single[word])
        starts = np.append(0, c.ends[:-1])
        known = np.add.reduceat((count[c.tokens] > 0).astype(np.int64), starts)
        base = np.add.reduceat(np.log10(single)[c.tokens], starts)
        score = np.add.reduceat(np.log10(p)[which], starts)
        ids = pa.array(c.ids, mask=(c.flags & 4) > 0)
        columns = [ids, pa.array((c.flags & 2) > 0), pa.array(np.diff(np.append(0, c.ends))), pa.array(known), pa.array(base), pa.array(score)]
        return pa.Table.from_arrays(columns, names=[f.split()[0] for f in _SCORES.split(", ")])

    return run


def score(docs: DataFrame, trains: Column, held: Column, chunk_tokens: int = CHUNK_TOKENS, shard_tokens: int = SHARD_TOKENS, discount: float = DISCOUNT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of (doc_id, text).

    Learns from rows where ``trains`` holds.  Null texts are empty and have the end as their only token; a row without an
    id is scored and teaches nothing if ``trains`` is null for it.  Repeated rows count and are scored each.
    Without training rows every token has the probability 1 / (V + 1) = 1.  Long texts are scored whole: a chunk holds at least
    one document.  ``discount`` (above 0, below 1) is what each seen pair gives to the unseen.
    """
    state = chunks(docs, trains, held, chunk_tokens)
    tokens = state.agg(F.sum("n")).first()[0] or 0
    shards = max(4, -(-tokens // shard_tokens))
    hot, hot_counts = _common_words(state, shards)
    asked = _each(state, _ask_pairs(shards, hot)).repartition(shards, "shard")
    pairs = materialize(asked.groupBy("shard").applyInArrow(_answer_pairs(shards, hot, hot_counts, discount), _ROW))
    words = _each(state, _ask_words(shards)).unionByName(pairs.where(F.col("kind") == _KINDS))
    words = materialize(words.groupBy("shard").applyInArrow(_answer_words, _ROW))
    v, n = words.where(F.col("kind") == _TOTALS).agg(F.coalesce(F.sum("shard"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = state.unionByName(words.where(F.col("kind") == _WORDS)).unionByName(pairs.where(F.col("kind") == _PAIRS))
    out = rows.groupBy("chunk").applyInArrow(_finish(shards, hot, n, v, discount), _SCORES)
    return out.withColumn("train_tokens", F.lit(n).cast("long"))


@query("op3_lm_scores")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole documents, learned from those whose crc32 of the id modulo 5 is not 1."""
    rest = id_remainder(F.col("doc_id"), 5)
    out = score(table(spark, sf_dir, "documents"), rest != 1, rest == 1)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
