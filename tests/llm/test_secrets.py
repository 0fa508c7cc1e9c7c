"""Candidates and features against plain Python, the forest on labelled findings, edge cases."""

import random
import re

from riffle.llm import secrets as se


def plain_candidates(rows):
    out = []
    for d, text, _ in rows:
        words = re.split(r"[ \t\n\r\f\x0B]", text or "")
        at = 0
        for i, w in enumerate(words):
            for t in dict.fromkeys(re.findall(se.TOKEN, w)):
                j = w.index(t)
                out.append((d, at + j, t, " ".join(words[max(0, i - 3) : i]) + " " + w[:j], w[j + len(t) :] + " " + (words[i + 1] if i + 1 < len(words) else "")))
            at += len(w) + 1
    return sorted(out, key=repr)


ROWS = [
    (1, 'my token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "a/b"), (1, 'my token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end', "a/b"),
    (2, None, "x"), (3, "", None), (4, "password:AAAAbbbbCCCC1234== internationalization,internationalization\n\tlast0123456789abcdef", None),
    (None, "x" * 50000 + " é " + "word " * 20000 + "0123456789abcdef", "test/y"),
]


def test_candidates_and_features_by_plain_python(spark):
    df = spark.createDataFrame([(*r, "q", 1) for r in ROWS], "doc_id long, text string, source string, token string, start int").repartition(3)
    found = se.candidates(df)
    assert sorted(((r.doc_id, r.start, r.token, r.before, r.after) for r in found.collect()), key=repr) == plain_candidates(ROWS)
    words = spark.createDataFrame([("internationalization",), ("dbebab",)], "word string")
    got = {r.token: r for r in se.features(found, words).collect()}
    a, b = got["04dbebab91ab85687d33eeaaf9ac699e1188f962"], got["internationalization"]
    assert (a.f_length, a.f_hex, a.m_secret_name, a.m_assigned, a.f_quoted, b.f_words) == (40, 1, 1, 1, 1, 1.0)
    assert a.f_digits == sum(c.isdigit() for c in a.token) / 40 and abs(a.f_words - 6 / 40) < 1e-9
    assert se.candidates(df.limit(0)).count() == 0


def test_known_words(spark):
    df = spark.createDataFrame([(i, f"Alpha beta{i} gamma alpha") for i in range(3)] + [(9, None)], "doc_id long, text string")
    assert sorted(r.word for r in se.known_words(df).collect()) == ["alpha", "gamma"]


def test_forest_removes_false_positives(spark):
    r = random.Random(8)
    syllables = ["the", "tion", "ing", "ble", "er"]
    rows, truth = [], {}
    for i in range(600):
        secret = i % 3 == 0
        token = "".join(r.choices("0123456789abcdef", k=32)) if secret else "".join(r.choices(syllables, k=6))
        lead = "api_key = " if secret else r.choice(["the word", "see =", "and"]) + " "
        rows.append((i, f"{lead}{token} more", "src"))
        truth[i] = secret
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = se.features(se.candidates(df), se.known_words(df))
    from pyspark.sql import functions as F

    labelled = found.where("doc_id < 300").withColumn("label", (F.col("doc_id") % 3 == 0).cast("int"))
    model = se.train(labelled, sample_rows=80)
    held = se.judge(found.where("doc_id >= 300"), model).collect()
    assert all((x.score > 0.5) == truth[x.doc_id] for x in held) and len(held) >= 250
    assert se.train(labelled.limit(0)) is None and se.judge(found, None).where("score <> 1").count() == 0


def test_forest_overrules_names(spark):
    """Learned from names alone, it finds secrets that none names and drops words that one does."""
    r = random.Random(4)
    syllables = ["the", "tion", "ing", "ble", "er"]
    hexes, spelled = lambda: "".join(r.choices("0123456789abcdef", k=32)), lambda: "".join(r.choices(syllables, k=6))
    rows = [(i, f'token = "{hexes()}" more' if i % 2 else f"as {spelled()} said", "src") for i in range(600)]
    rows += [(600 + i, f'token = "{spelled()}" more', "src") for i in range(30)]
    rows += [(700 + i, f'value "{hexes()}" more', "src") for i in range(40)]
    rows += [(800 + i, f'called "{spelled()}" more', "src") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labelled = se.name_labels(se.features(se.candidates(df), se.known_words(df)))
    assert not set(se.MARKS) & set(se.FEATURES)
    got = {x.doc_id: (x.label, x.score > 0.5) for x in se.judge(labelled, se.train(labelled)).collect()}
    named, unnamed = [got[i] for i in range(600, 630) if i in got], [got[i] for i in range(700, 740)]
    assert sum(not s for _, s in named) >= 0.9 * len(named) and {x for x, _ in named} == {1}
    assert all(s for _, s in unnamed) and {x for x, _ in unnamed} == {0}


def test_query_on_nulls_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, source string, lang string"
    for n, rows in enumerate(([], [(None, None, None, None), (1, None, "a", "en"), (2, "", None, None)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{n}/documents.parquet")
        assert se.op5(spark, f"{tmp_path}/{n}").count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(d, m.start(1)) for d, t in texts.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    got = {(r.doc_id, r.start) for r in se.op5(spark, sf).collect()}
    assert want and len(want & got) >= 0.97 * len(want) and len(got - want) <= 0.05 * len(want) + 1
