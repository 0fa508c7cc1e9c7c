"""The stages against plain versions on a small table with planted cases."""

import random

import corpus_pipeline as cp
from pyspark.sql import functions as F
from test_decontaminate import fold, least_edits
from test_linededup import brute as plain_lines
from test_minhash import brute as plain_groups

from riffle.llm import decontaminate as dc


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(6)
    r = random.Random(3)
    base = docs.where("length(text) < 900").limit(70).collect()
    rows = [tuple(x) for x in base]
    leak = items.first().text
    rows += [(9001, rows[0][1], rows[0][2], "src3", 1), (9002, rows[1][1] + " the end", rows[1][2], "src4", 1)]
    rows += [(9003, rows[2][1] + "\n" + leak, rows[2][2], "src5", 1), (9004, None, "en", "src1", 0), (9005, " 12 ?", "en", None, 0)]
    rows += [(9100 + i, f"{r.choice(rows[:70])[1]}\nCopyright and all that for ever", "en", f"src{i}", 1) for i in range(7)]
    sf = str(tmp_path)
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{sf}/documents.parquet")
    items.write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    for name, stage in cp.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
        steps[name] = docs
        if name != "tokens":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    # only documents without a letter are rejected here
    kept = {x.doc_id for x in steps["language"].collect()}
    assert kept == {x[0] for x in rows} - {9004, 9005}
    before = [(x.doc_id, x.text, x.source) for x in steps["language"].collect()]
    assert sorted(((x.doc_id, x.text) for x in steps["lines"].collect())) == [x[:2] for x in sorted(plain_lines(before, 5, 0.5))]
    groups = plain_groups([(x.doc_id, x.text) for x in steps["lines"].collect()], 5, 80)
    assert {x.doc_id for x in steps["duplicates"].collect()} == {d for d, (_, c) in groups.items() if c == d}
    index = dc.cut([(x.item_id, x.text) for x in items.collect()])
    windows = ["".join(map(chr, w)) for w in index.codes]

    def clean(text):
        return all(least_edits(w, fold(text)) > dc.edit_budget(len(w)) for w in windows)

    assert {x.doc_id for x in steps["benchmark"].collect()} == {x.doc_id for x in steps["duplicates"].collect() if clean(x.text)}
    assert 9003 not in {x.doc_id for x in steps["benchmark"].collect()}
    last = steps["tokens"].collect()
    assert {x.doc_id for x in last} == {x.doc_id for x in steps["benchmark"].collect()} and all(x.round_trip for x in last)
    ran = cp.run(spark, sf)
    assert {(x.doc_id, x.n_tokens) for x in ran.collect()} == {(x.doc_id, x.n_tokens) for x in last}


def test_rows_of_one_id_are_judged_by_their_own_text(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [x.text for x in docs.where("length(text) between 300 and 900").orderBy("doc_id").limit(40).collect()]
    items = spark.createDataFrame([(1, texts[30])], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, texts[i], "own") for i in range(10)]
    rows += [(3, texts[1], "copy of 1"), (3, texts[20], "other"), (3, texts[20], "other"), (4, texts[30], "leak"), (None, texts[21], "none"), (None, texts[30], "leak")]
    rows += [(11, None, "null"), (12, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("rejected", F.col("score")).withColumn("n_lines", F.lit("x"))
    df = df.withColumn("lang", F.lit("fr")).withColumn("source", F.lit("a")).withColumn("n_chars", F.length("text").cast("long"))
    once = cp.duplicates(spark, df, str(tmp_path))
    assert once.columns == df.columns
    assert sorted(map(repr, once.select("doc_id", "text", "score").collect())) == sorted(map(repr, (r for r in df.select("doc_id", "text", "score").collect() if r.score != "copy of 1")))
    clean = cp.benchmark(spark, df, str(tmp_path))
    assert sorted(r.score for r in clean.collect()) == sorted(r[2] for r in rows if r[2] != "leak")
    cut = cp.lines(spark, df, str(tmp_path))
    assert cut.columns == df.columns and {r.n_lines for r in cut.collect()} == {"x"} and cut.count() == len(rows)
    big = docs.withColumn("score", F.lit("mine")).withColumn("rejected", F.lit("no")).withColumn("lang_pred", F.lit(7))
    named = cp.language(spark, big, str(tmp_path))
    assert named.columns == big.columns and {(r.score, r.rejected, r.lang_pred) for r in named.select("score", "rejected", "lang_pred").distinct().collect()} == {("mine", "no", 7)}


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
