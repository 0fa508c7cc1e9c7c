"""Corpus, exam items, the stream, and the shape of plans."""

import numpy as np
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.plans.corpus import build_question_corpus, exam_items
from riffle.plans.linear import LinearModel
from riffle.streaming.partial_fit import apply_batch, load_state, partial_fit, partial_fit_stream, weights_by_batch


def test_question_corpus(spark):
    q = spark.createDataFrame(
        [("q1", 3, "<p>stem</p><img src='a.png'>", "<p>opt</p>"), ("q1", 3, "<p>stem</p><img src='a.png'>", "<p>opt</p>"),
         ("q2", 2, "<p>no picture</p>", None), ("q3", 1, "<p>x</p><img src='b.png'>", "<img src='c.png'>")],
        "question_uid string, qdiff int, body string, answer string",
    )
    links = spark.createDataFrame([("q1", "k1"), ("q1", "k2"), ("q3", "k9")], "question_uid string, knowledge_uid string")
    know = spark.createDataFrame([("k1", 2), ("k2", 1)], "knowledge_uid string, subject int")
    out = build_question_corpus(q, links, know, F.col("subject") == 2, ["body", "answer"])
    assert sorted((r["question_uid"], r["qtext"], r["qimage"]) for r in out.collect()) == [
        ("q1", "stemopt", ",a.png"), ("q3", "x", ",b.png,c.png"),
    ]
    narrow = build_question_corpus(q, links, know, F.col("subject") == 2, ["body", "answer"], how="inner")
    assert [r["question_uid"] for r in narrow.collect()] == ["q1"]


def test_exam_items(spark):
    pages = spark.createDataFrame(
        [("s", "c", "A1", "stem", ["i.png"], ["a", "b", "", "d", "e"], "x\n正确答案：A"),
         ("s", "c", "案例题", "case", None, ["a"], "y"), ("s", "c", "?", "z", None, None, "")],
        "sub_type string, sub_con string, marker string, stem string, images array<string>, options array<string>, answer string",
    )
    got = [tuple(r) for r in exam_items(pages).collect()]
    assert got == [
        ("s", "c", "单选题", "stem<i.png>", "a", "b", "d", "e", "", "正确答案：A"),
        ("s", "c", "简答题", "case", "", "", "", "", "", "y"),
    ]


def test_stream_equals_batch_steps_and_replay_is_harmless(spark, tmp_path):
    rng = np.random.default_rng(1)
    schema = "a double, b double, y int"
    frames = []
    for n in range(3):
        x = rng.normal(size=(30, 2))
        frames.append(spark.createDataFrame([(float(r[0]), float(r[1]), int(r[0] > r[1]) * 2 - 1) for r in x], schema).coalesce(1))
    model = LinearModel(["a", "b"], np.zeros(3))
    folder, source = str(tmp_path / "state"), str(tmp_path / "in")
    for n, f in enumerate(frames):
        f.write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        partial_fit_stream(stream, ["a", "b"], "y", folder, eta=0.01).awaitTermination()
        model = partial_fit(f, model, "y", 0.01)
    assert np.allclose(load_state(spark, folder, 2), model.weights)
    apply_batch(frames[1], 1, np.zeros(3), folder, ["a", "b"], "y", 0.01)
    apply_batch(frames[2], 2, np.zeros(3), folder, ["a", "b"], "y", 0.01)
    assert np.allclose(load_state(spark, folder, 2), model.weights)
    assert [r["rows"] for r in weights_by_batch(spark, folder).orderBy("batch").collect()] == [30, 30, 30]


def test_scan_reads_only_needed_columns(spark, capsys):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    A.interaction_counts(lines.filter("l_quantity > 10"), "l_orderkey", "l_partkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan
