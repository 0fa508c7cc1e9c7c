"""Occurrences against plain semi-global alignment; edge cases; planted items on the given tables."""

import random

import numpy as np
import pytest

from riffle.llm import decontaminate as dc


def least_edits(pattern, text):
    """Fewest edits between the pattern and any stretch of the text (Sellers)."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(last[j - 1] + (p != t), last[j] + 1, row[-1] + 1))
    return min(row)


def fold(text):
    codes, _ = dc.folded([text])
    return "".join(chr(c) for c in codes if c).strip()


def spoiled(r, text, n):
    out = list(text)
    for _ in range(n):
        at = r.randrange(len(out))
        out[at : at + 1] = r.choice(["", "x", out[at] + "y"])
    return "".join(out)


@pytest.mark.parametrize("seed", range(6))
def test_windows_found_as_by_plain_alignment(seed):
    r = random.Random(seed)
    words = ["the", "of", "and", "tion", "ring", "then", "erst", "ou", "ble", "wh"]
    prose = lambda n: " ".join("".join(r.choices(words, k=r.randint(1, 3))) for _ in range(n))
    items = [(i, prose(n)) for i, n in enumerate((4, 6, 9, 14, 30, 60))]
    index = dc.cut(items)
    texts = []
    for _, item in items:
        for n in (0, 1, 2, 4, 6, 7, 8, 12):
            texts.append(prose(12) + " " + spoiled(r, item, n) + " " + prose(9))
    for text in texts:
        codes, _ = dc.folded([text])
        got = {w for w, *_ in dc.occurrences(codes, index)}
        plain = fold(text)
        want = {w for w, p in enumerate(index.codes) if least_edits("".join(map(chr, p)), plain) <= dc.edit_budget(len(p))}
        assert got == want


def test_spans_nulls_and_clashes(spark):
    item = "Shared passage: numbers 12 and 14, of the Benchmark; it is fairly long."
    docs = [(1, f"Intro é.\n{item.upper()} tail", 5), (1, f"Intro é.\n{item.upper()} tail", 5), (2, None, 5), (3, "", 5), (4, "clean words " * 30000, 5), (None, item, 5)]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(7, item, 1), (8, None, 1), (9, "too short", 1), (None, item, 1)], "item_id long, text string, doc_id long")
    rows = sorted((str(r.doc_id), r.item_id, r.first_char, r.end_char, r.edits) for r in dc.leaks(df, bench).collect())
    assert rows == [("1", 7, 9, 9 + len(item) - 1, 0), ("1", 7, 9, 9 + len(item) - 1, 0), ("None", 7, 0, len(item) - 1, 0)]
    assert dc.leaks(df.limit(0), bench).count() == 0 and dc.leaks(df, bench.limit(0)).count() == 0


def test_blocks_give_the_same_rows(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    want = sorted(map(tuple, dc.op2(spark, sf).collect()))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 3000)
    assert sorted(map(tuple, dc.op2(spark, sf).collect())) == want


def test_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r for r in dc.op2(spark, sf).collect()}
    whole = {(d, i) for d, t in docs.items() for i, b in bench.items() if b in t}
    assert whole and whole <= set(got)
    for (d, i), r in got.items():
        if (d, i) in whole:
            assert fold(docs[d][r.first_char : r.end_char]) == fold(bench[i])
    clean = [d for d, _ in set(got) - whole]
    assert len(clean) <= 0.005 * len(docs)
    assert np.all([0 <= r.first_char < r.end_char <= len(docs[r.doc_id]) for r in got.values()])
