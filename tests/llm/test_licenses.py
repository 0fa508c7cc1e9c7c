"""Phrase places and template blocks against plain loops; edge cases."""

import math
import random
import re

from riffle.llm import licenses as li

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, templates, share):
    w = words_of(text)
    places, base = [], set()
    for p, label in li.PHRASES.items():
        p = p.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    size = 2 * max(li.BLOCK_WORDS // 2, max(len(t.split()) for _, t in templates))
    step, best, labels = size // 2, 0.0, set(base)
    for i in range(max(1, math.ceil(len(w) / step) - 1) if w else 0):
        block = set(w[i * step : i * step + size])
        for label, t in templates:
            own = set(words_of(t))
            if own and len(own & block) >= share * len(own) - 1e-9:
                labels.add(label)
                best = max(best, len(own & block) / len(own))
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else best)


def check(spark, rows, templates, share):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, labels string, key int").repartition(3)
    got = sorted(((r.doc_id, *tuple(r)[1:7], round(r.score, 9)) for r in li.scan(df, templates, share=share).collect()), key=repr)
    want = sorted(((d, *plain(t, templates, share)[:6], round(plain(t, templates, share)[6], 9)) for d, t in rows), key=repr)
    assert got == want


def test_places_and_edges(spark):
    texts = [None, "", " .,;", "MIT License", "mit license mit license", "x Apache-LICENSE, y; the MIT  License. General public license", "mit licenses", "lamit license", "word " * 60000 + "MIT license", "ñ mit license é", "a\nb\x00c"]
    check(spark, [(i, t) for i, t in enumerate(texts)] + [(3, "MIT License"), (None, "mit license")], li.TEMPLATES, 0.8)
    assert li.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_containment_by_plain_loops(spark):
    r = random.Random(6)
    common = [f"c{i}" for i in range(12)] + ["the", "of", "to"]
    templates = [(f"t{i}", " ".join(r.choices(common + [f"rare{i}", f"odd{i}"], k=r.randint(1, 14)))) for i in range(9)] + li.TEMPLATES[:3] + [("none", " . ")]
    rows = []
    for i in range(150):
        text = r.choices(common, k=r.randint(0, 60))
        for _ in range(r.randint(0, 3)):
            t = r.choice(templates)[1].split()
            text[r.randint(0, len(text)) : 0] = [w for w in t if r.random() < 0.85]
        rows.append((i, " ".join(text)))
    for share in (0.6, 0.8, 1.0):
        check(spark, rows, templates, share)


def test_positional_filter_removes_pairs_and_loses_none(spark):
    """Blocks that hold enough template words of any kind, but too few behind the rarest one they share."""
    from pyspark.sql import functions as F

    r = random.Random(9)
    words = [f"w{i}" for i in range(40)]
    templates = [(f"t{i}", " ".join(r.sample(words, 10))) for i in range(8)]
    docs = spark.createDataFrame([(i, " ".join(r.sample(words, 8))) for i in range(2000)], "doc_id long, text string")
    texts = docs.select(F.col("doc_id").alias("key"), li.words_text(F.col("text")).alias("_words"))
    common = F.size(F.array_intersect("tokens", "held"))
    found = {}
    for positional in (False, True):
        pairs = li.candidate_pairs(texts, templates, 0.6, 64, positional)
        found[positional] = (pairs.count(), sorted(map(tuple, pairs.where(common >= F.col("need")).select("key", "template").collect())))
    assert found[True][0] < found[False][0] * 0.8 and found[True][1] == found[False][1] and found[True][1]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in li.op6(spark, sf).collect()}
    assert got == {d: plain(t, li.TEMPLATES, li.CONTAINMENT) for d, t in rows.items()}
    assert any(g[1] for g in got.values())
