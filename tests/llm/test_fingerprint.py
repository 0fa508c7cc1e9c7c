"""Entropies and features against plain loops, order of documents, edge cases."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from riffle.llm import fingerprint as fp
from riffle.llm.common import text_bytes


def bytes_of(texts):
    return text_bytes(pa.array(texts, pa.large_string()))


def test_entropies_by_plain_count():
    r = random.Random(1)
    data = np.array([r.choice(b"abcdefgh \n") for _ in range(700)] + [97] * 100, dtype=np.uint8)
    got = fp.window_entropies(data)
    for i in range(len(got)):
        h = -sum(c / 64 * math.log2(c / 64) for c in Counter(data[i : i + 64].tolist()).values())
        assert abs(got[i] - h / 6 * 1000) <= 1.01
    assert len(got) == len(data) - 63 and not len(fp.window_entropies(data[:63]))


def plain_features(data, rank):
    entropy = fp.window_entropies(data)
    if not len(entropy):
        return []
    points = Counter()
    for s in range(max(1, len(entropy) - 63)):
        part = [rank[e] for e in entropy[s : s + 64]]
        points[s + part.index(min(part))] += 1 if len(entropy) >= 64 else 16
    return [p for p in sorted(points) if points[p] >= 16 and rank[entropy[p]] <= 1000]


def test_features_by_plain_loops(monkeypatch):
    monkeypatch.setattr(fp, "_TILE", 100)
    r = random.Random(2)
    rank = np.array(random.Random(3).sample(range(1001), 1001))
    rank[:100] = 1001
    texts = ["".join(r.choices("abcdefghij ü", k=n)) for n in (0, 10, 63, 64, 70, 126, 127, 128, 900, 0, 400)] + ["z" * 300]
    data, offsets = bytes_of(texts)
    row, _ = fp.features(data, offsets, rank)
    for i in range(len(texts)):
        want = len(plain_features(data[offsets[i] : offsets[i + 1]], rank)) or int(len(texts[i]) > 0)
        assert np.sum(row == i) == want


def test_equal_texts_equal_prints_and_likeness():
    r = random.Random(4)
    a, b = ("".join(r.choices("abcdefghijklmnop ", k=9000)) for _ in range(2))
    rank = np.arange(1001)
    p = fp.Prints(*bytes_of([a, b, a, a[:4500] + b[:4500], "", ""]), rank)
    assert p.text(0) == p.text(2) and p.text(0) != p.text(1)
    assert fp.likeness(p, 0, p, 2) == 1.0 and fp.likeness(p, 0, p, 1) < 0.1
    assert 0.15 < fp.likeness(p, 0, p, 3) < 0.9
    assert fp.likeness(p, 4, p, 5) == 1.0 and fp.likeness(p, 0, p, 4) == 0.0


def plain_edited(docs):
    ordered = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    texts = [t or "" for _, t in ordered]
    return [(d, fp.edited(t, texts[(i + 1) % len(texts)]), t, texts[(i + 1) % len(texts)]) for i, ((d, _), t) in enumerate(zip(ordered, texts))]


def test_next_document_over_ranges(spark):
    r = random.Random(5)
    docs = [(i * 3, "".join(r.choices("abcdé ", k=r.choice([0, 1, 5, 100, 700])))) for i in range(300)]
    docs += [(9, "again"), (9, "again"), (12, None), (None, "no id"), (5000, "long " * 30000)]
    for rows in (docs, docs[:1], docs[:2]):
        df = spark.createDataFrame([(*d, "x", 1) for d in rows], "doc_id long, text string, tail string, range int").repartition(6)
        out = fp.compare_with_next(df).collect()
        want = plain_edited(rows)
        assert sorted(map(str, ((x.doc_id, x.edited_text) for x in out))) == sorted(map(str, (w[:2] for w in want)))
        assert all(0 <= x.near_edited <= 1 and 0 <= x.near_next <= 1 for x in out)
    assert fp.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(x.doc_id, x.text) for x in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: (e, t, n) for d, e, t, n in plain_edited(rows)}
    got = {x.doc_id: x for x in fp.op8(spark, sf).collect()}
    assert set(got) == set(want)
    prints = {}
    for d, (e, t, n) in want.items():
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert prints.setdefault(t, got[d].fingerprint) == got[d].fingerprint
    assert np.mean([x.near_edited for x in got.values()]) > 0.25 > np.mean([x.near_next for x in got.values()])


def test_likeness_by_plain_pairs_and_bounded_memory():
    """Filter by filter as one formula over all pairs of filters; two texts of 4 MB take little beside their prints."""
    import tracemalloc

    r = random.Random(6)
    text = lambda n: "".join(r.choices("abcdefghijklmnop ", k=n))
    base = text(60_000)
    p = fp.Prints(*bytes_of([base, base[:30_000] + text(50_000), text(20_000), base[20_000:40_000], text(70)]), np.arange(1001))

    def plain(i, j):
        if (p.at[i + 1] - p.at[i], p.total[i]) > (p.at[j + 1] - p.at[j], p.total[j]):
            i, j = j, i
        miss, total, weight = (1 - 1 / fp.FILTER_BITS) ** fp.HASHES, 0.0, 0
        for f in range(p.at[i], p.at[i + 1]):
            best = 0.0
            for g in range(p.at[j], p.at[j + 1]):
                common = sum(bin(int(a) & int(b)).count("1") for a, b in zip(p.filters[f], p.filters[g]))
                most = min(p.set[f], p.set[g])
                least = fp.FILTER_BITS * (1 - miss ** p.held[f]) * (1 - miss ** p.held[g])
                floor = fp.CHANCE * max(most - least, 0) + min(least, most)
                best = max(best, 1.0 if common == most else min(1.0, max(0.0, (common - floor) / max(most - floor, 1e-9))))
            total, weight = total + best * p.held[f], weight + p.held[f]
        return total / weight

    for i in range(5):
        for j in range(5):
            assert abs(fp.likeness(p, i, p, j) - plain(i, j)) < 1e-9
    long = fp.Prints(*bytes_of([text(4_000_000), text(4_000_000)]), np.arange(1001))
    tracemalloc.start()
    fp.likeness(long, 0, long, 1)
    assert tracemalloc.get_traced_memory()[1] < 4 * long.filters.nbytes + (1 << 20)
    tracemalloc.stop()
