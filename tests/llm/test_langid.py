"""Smoothing against a plain recursion, held-out accuracy, edge cases."""

import math
from collections import Counter

import numpy as np

from riffle.llm import langid


def plain_kn(texts, order):
    """Interpolated Kneser-Ney by the book, on code tuples."""
    top = Counter()
    codes, _ = langid.character_codes(texts, order)
    codes = codes.tolist()
    for i, c in enumerate(codes):
        if c != langid.START:
            top[tuple(codes[i - order + 1 : i + 1])] += 1
    levels = {order: top}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    alphabet = len({c for g in top for c in g})

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (alphabet + 1)
        counts = levels[k]
        n1, n2 = (sum(v == x for v in counts.values()) for x in (1, 2))
        d = min(0.95, max(0.1, n1 / max(1, n1 + 2 * n2)))
        own = [v for g, v in counts.items() if g[:-1] == gram[:-1]]
        if not own:
            return p(gram[1:])
        return max(counts[gram] - d, 0) / sum(own) + d * len(own) / sum(own) * p(gram[1:])

    return top, p


def test_smoothing_is_kneser_ney():
    texts = ["the cat sat on the mat", "That hat, the rat!", "éa éa"]
    order = 3
    top, p = plain_kn(texts, order)
    grams = np.array(list(top), dtype=np.uint32)
    model = langid.smooth(np.zeros(len(grams), int), grams, np.array(list(top.values())), ["x"])
    asked = np.array([*top, (32, 116, 120), (99, 99, 99), (1, 1, 116)], dtype=np.uint32)
    got = model.log_probabilities(asked)[:, 0]
    assert np.allclose(got, [math.log(p(tuple(g))) for g in asked.tolist()], atol=1e-5)


def test_codes_are_folded_and_rows_kept():
    codes, row = langid.character_codes(["Ab1c", None, "É"], 2)
    assert "".join(map(chr, codes)) == "\x01 ab c \x01 \x01 é "
    assert np.bincount(row).tolist() == [7, 2, 4]


def test_edge_rows_and_no_model(spark):
    rows = [(i, t, g, "old") for i, (t, g) in enumerate([("the cat and the hat and that", "en"), ("der hund und die katze und", "de")] * 40)]
    rows += [(100, None, "en", "x"), (101, "", None, "x"), (102, "12 !", "de", "x"), (None, "the dog", "en", "x"), (104, "und die " * 20000, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)
    out = {r.doc_id: r for r in langid.identify(df, langid.fit(df)).collect()}
    assert len(out) == 85
    assert [out[i].lang_pred for i in (0, 1, 100, 101, 102, None, 104)] == ["en", "de", "und", "und", "und", "en", "de"]
    assert all(0 <= r.score <= 1 for r in out.values()) and out[102].rejected and not out[0].rejected
    none = langid.identify(df, langid.fit(df.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert langid.identify(df.limit(0), None).count() == 0


def test_rejects_noise_keeps_prose(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(langid.learnable(docs))
    assert langid.identify(docs, model).where("rejected").count() == 0
    noise = spark.createDataFrame([(1, "xqzjv kwqzx jjxqv wvkzq " * 30), (2, "кошка и собака " * 30)], "doc_id long, text string")
    assert [r.rejected for r in langid.identify(noise, model).collect()] == [True, True]


def test_query_accuracy(spark):
    sf = "/root/testdata/sf0.001"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = langid.op9(spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and held
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
