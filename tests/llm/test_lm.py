"""Sequences and trie against sorted lists, scores against plain counts, probabilities that add up."""

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riffle.llm import lm
from riffle.llm.eliasfano import EliasFano, Trie


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 6), (300, 1 << 64), (1000, 1 << 30), (50, 3_000_000_000)])
def test_elias_fano(n, universe):
    r = random.Random(n)
    values = np.array(sorted(r.randrange(universe) for _ in range(n)), dtype=np.uint64)
    low_bits, lows, highs = EliasFano.pack(values, universe)
    seq = EliasFano(low_bits, n, lows, highs)
    assert n == 0 or (seq.get(np.arange(n)) == values).all()
    asked = np.array([*values.tolist(), *(r.randrange(universe) for _ in range(200))], dtype=np.uint64)
    assert (seq.find(asked) == np.searchsorted(values, asked)).all()


def test_trie():
    r = random.Random(2)
    pairs = {(r.randrange(1 << 64) if i % 3 else 77, r.randrange(1 << 40)): r.randrange(1, 60000) for i in range(900)}
    keys = sorted(pairs)
    trie = Trie(np.array([k[0] for k in keys], np.uint64), np.array([k[1] for k in keys], np.uint64), np.array([pairs[k] for k in keys]), 40)
    asked = [*keys, (77, 5), (3, 9), (keys[5][0], keys[7][1]), ((1 << 64) - 1, 1)]
    got = trie.lookup(np.array([a for a, _ in asked], np.uint64), np.ones(len(asked), int), np.array([b for _, b in asked], np.uint64))
    assert got.tolist() == [pairs.get(k, 0) for k in asked]
    degrees = Counter(k[0] for k in keys)
    assert dict(zip(*(x.tolist() for x in trie.degrees()))) == degrees
    p = np.array([1.0, 0.99, 0.25, 1e-6, 2.5e-13])
    assert np.allclose(lm.restored(lm.quantise(p)), p, rtol=3e-4) and lm.restored(np.zeros(1, np.uint16))[0] == 0


def tokens_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*low.encode().split(), "END"]


def plain(rows, trains):
    one, two, kinds = Counter(), Counter(), defaultdict(set)
    for (_, text), t in zip(rows, trains):
        before = "START"
        if t:
            one["START"] += 1
            for w in tokens_of(text):
                one[w] += 1
                two[before, w] += 1
                kinds[before].add(w)
                before = w
    total = sum(one.values()) - one["START"]
    v = len([w for w in one if w != "START" and one[w]])
    d = lm.DISCOUNT
    p1 = lambda w: (one.get(w, 0) + 0.5) / (total + 0.5 * (v + 1))

    def p(w, before):
        c = one.get(before, 0)
        if not c:
            return p1(w)
        seen = two.get((before, w), 0)
        stored = lm.restored(lm.quantise(np.array([(seen - d) / c])))[0] if seen else 0.0
        return stored + d * len(kinds.get(before, ())) / c * p1(w)

    out = []
    for doc, text in rows:
        t = tokens_of(text)
        base = sum(math.log10(p1(w)) for w in t)
        full = sum(math.log10(p(w, b)) for b, w in zip(["START", *t], t))
        out.append((doc, len(t), sum(one.get(w, 0) > 0 for w in t), total, round(base, 6), round(full, 6)))
    vocabulary = [w for w in one if w != "START"] + ["unknown"]
    return sorted(out, key=repr), {b: sum(p(w, b) for w in vocabulary) for b in [*list(one)[:20], "never"] if b != "END"}


def got(df):
    return sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in df.collect()), key=repr)


def remainder(d):
    return None if d is None else zlib.crc32(str(d).encode()) % 5


@pytest.mark.parametrize("chunk,shard", [(3_000_000, 2_000_000), (400, 150)])
def test_scores_by_plain_counts(spark, chunk, shard):
    r = random.Random(9)
    words = ["the", "The", "of", "é", *(f"w{i}" for i in range(60))]
    rows = [(i, " ".join(r.choices(words, weights=[30, 10, 10, 5] + [1] * 60, k=r.randint(0, 40)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \t "), (None, "the of w1"), (3, rows[3][1]), (504, "hot cold " * 3000), (505, "x" * 5000)]
    df = spark.createDataFrame([(*x, "q", 1) for x in rows], "doc_id long, text string, score string, chunk int").repartition(4)
    from pyspark.sql import functions as F

    rest = lm.id_remainder(F.col("doc_id"), 5)
    out = lm.score(df, rest != 1, rest == 1, chunk, shard)
    want, sums = plain(rows, [remainder(d) not in (None, 1) for d, _ in rows])
    assert got(out) == want
    assert all(abs(s - 1) < 3e-4 for s in sums.values())
    assert {x.doc_id for x in out.where("held_out").collect()} == {d for d, _ in rows if remainder(d) == 1}


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    from pyspark.sql import functions as F

    assert lm.score(df.limit(0), F.lit(True), F.lit(False)).count() == 0
    r = lm.score(df, F.lit(False), F.lit(True)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) == (3, 0, 0, 0.0, 0.0, True)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = lm.op3(spark, sf)
    assert got(out) == plain(rows, [remainder(d) != 1 for d, _ in rows])[0]
    held = out.where("held_out").toPandas()
    assert held.score.sum() > held.base_score.sum()


def test_packing_needs_little_memory():
    values = np.cumsum(np.random.default_rng(1).integers(1, 1 << 30, 1_000_000)).astype(np.uint64)
    tracemalloc.start()
    low_bits, lows, highs = EliasFano.pack(values, 1 << 50)
    packed, peak = len(lows) + len(highs), tracemalloc.get_traced_memory()[1]
    seq = EliasFano(low_bits, len(values), lows, highs)
    beside = seq.highs.ones.nbytes
    tracemalloc.stop()
    assert peak < packed + 16 * (1 << 20) and beside < packed / 20
    at = np.arange(0, 1_000_000, 997)
    assert (seq.get(at) == values[at]).all() and (seq.find(values[at]) == at).all() and (seq.find(values[at] + np.uint64(1)) == at + 1).all()
