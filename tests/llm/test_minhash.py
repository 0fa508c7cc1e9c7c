"""Groups against all pairs, hot groups in small blocks, edge cases."""

import random
import re

import pytest

from riffle.llm import graph, minhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[top(i)] = min(low.get(top(i), d), d)
    return {d: (len(sets[i]), low[top(i)]) for i, (d, _) in enumerate(rows)}


def corpus(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = [(1000, ""), (1001, " \t\n"), (1002, "one"), (1003, "ONE "), (1004, "one two"), (1005, "x " * 4000)]
    base = [r.choice(words) for _ in range(120)]
    for i in range(n):
        if i % 3 == 0:
            text = [r.choice(words) for _ in range(r.randint(1, 80))]
        else:
            text = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3, 5, 8])):
                text[r.randrange(120)] = r.choice(words)
        rows.append((i * 7 % 997, " ".join(text)))
    return rows


@pytest.mark.parametrize("k,percent,block", [(3, 85, 1 << 18), (3, 85, 2000), (5, 80, 1500)])
def test_groups_against_all_pairs(spark, k, percent, block):
    rows = corpus(block, 240)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k, percent, block).collect()}
    assert got == brute(rows, k, percent)


def test_nulls_repeats_and_clashes(spark):
    rows = [(1, "a b c d e f g", 9, "q"), (1, "a b c d e f g", 8, "q"), (2, None, 1, None), (None, "a b c d e f g", 1, "z"), (3, "A b C d e f g", 1, "z"), (3, "other words are here now", 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id long, d1 string")
    out = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert out == [("1", 3, 1, True), ("1", 3, 1, True), ("2", 0, 2, True), ("3", 1, 3, True), ("3", 3, 1, False), ("None", 3, None, True)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_path(spark):
    pairs = [(i, i + 1) for i in range(100, 160)] + [(3, 9), (9, 3), (5, 5)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {3: 3, 9: 3}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.op4(spark, sf).collect()}
    assert got == brute(rows, 3, 85)
