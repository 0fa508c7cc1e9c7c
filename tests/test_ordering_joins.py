import random

import pytest
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.operators import joins as J
from riffle.operators import ordering as O


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_global_index_and_running_total(spark):
    rnd = random.Random(1)
    data = [(i, rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id long, k int, x double").repartition(7)
    want = sorted(data, key=lambda r: (-r[1], r[0]))
    got = {r["id"]: r["pos"] for r in O.global_index(df, [F.col("k").desc(), "id"], "pos").collect()}
    assert got == {r[0]: n for n, r in enumerate(want)}
    run = {r["id"]: (r["a"], r["b"]) for r in O.running_total(df, [F.col("k").desc(), "id"], {"a": "x"}, {"b": "x"}).collect()}
    total = 0.0
    for (i, _, x), nxt in zip(want, [*want[1:], None]):
        assert abs(run[i][1] - total) < 1e-9
        total += x
        assert abs(run[i][0] - total) < 1e-9
        if nxt:
            assert run[i][0] == run[nxt[0]][1]


def test_global_index_of_empty_table(spark):
    df = spark.createDataFrame([], "id long")
    assert O.global_index(df, ["id"], "pos").count() == 0


def test_positions_with_one_large_key(spark):
    data = [("hot", i) for i in range(2000)] + [("a", 5), ("a", 1), ("b", 0)]
    got = O.positions(spark.createDataFrame(data, "k string, v int").repartition(5), "k", ["v"]).collect()
    assert {(r["k"], r["v"]): r["pos"] for r in got if r["k"] != "hot"} == {("a", 1): 0, ("a", 5): 1, ("b", 0): 0}
    assert all(r["v"] == r["pos"] for r in got if r["k"] == "hot")


def test_label_encode_keeps_order_and_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x string")
    assert sorted(O.label_encode(df, ["x"]).toPandas()["x"].dropna().tolist()) == [0, 0, 1, 2]
    assert O.label_encode(df, ["x"]).filter("x is null").count() == 1


def test_vocabularies_in_one_pass(spark):
    df = spark.createDataFrame([(10, "b|a"), (9, "c"), (None, None)], "n int, t string")
    got = rows(O.vocabularies([(df, {"n": F.col("n")}), (df, {"t": F.split("t", r"\|")}), (df, {"n": F.col("n")})]))
    assert got == [("n", "10", 1), ("n", "9", 0), ("t", "a", 0), ("t", "b", 1), ("t", "c", 2)]


def test_salted_lookup_equals_plain(spark):
    fact = spark.createDataFrame([("hot", i % 7) for i in range(500)] + [("x", 1), (None, 2), ("gone", 3)], "k string, v int")
    dim = spark.createDataFrame([("hot", 1.0), ("x", 2.0), ("unused", 3.0)], "k string, d double")
    plain = J.lookup_join(fact, dim, "k")
    salted = J.lookup_join(fact, dim, "k", rows_per_split=50)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))
    assert rows(J.hot_keys(fact, ["k"], 50)) == [("hot", 10)]


def test_candidate_counts_equal_the_or_join(spark):
    rnd = random.Random(2)
    left = [(i, rnd.choice([1, 1, 1, 2, 3, None]), rnd.randint(0, 9)) for i in range(80)]
    right = [(rnd.choice([1, 1, 2, 4, None]), rnd.randint(0, 9)) for _ in range(120)]
    got = J.candidate_counts(
        spark.createDataFrame(left, "id int, a int, b int"), spark.createDataFrame(right, "a int, b int"), ("a", "b")
    )
    want = {i: sum((a is not None and a == x) or b == y for x, y in right) for i, a, b in left}
    assert {r["id"]: r["candidates"] for r in got.collect()} == want


def test_prefix_join(spark):
    names = spark.createDataFrame([("s", "ab12.png"), ("s", "abc.png"), ("t", "ab.png"), ("s", "")], "scope string, name string")
    ids = spark.createDataFrame([("s", "ab"), ("s", "ab"), ("s", "abc"), ("t", "zz"), ("s", "")], "scope string, id string")
    got = rows(J.prefix_join(names, ids, "scope", "name", "id").select("name", "id"))
    assert got == [("ab12.png", "ab"), ("abc.png", "ab"), ("abc.png", "abc")]


def test_conditions_in_on_keep_left_rows(spark):
    q = spark.createDataFrame([(1,), (2,), (3,)], "q int")
    link = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "q int, k int")
    know = spark.createDataFrame([(10, 2), (11, 1), (12, 1)], "k int, subject int")
    left = J.questions_with_knowledge(q, link, know, "q", "k", F.col("subject") == 2)
    assert sorted((r["q"], r["subject"] or 0) for r in left.collect()) == [(1, 0), (1, 2), (2, 0), (3, 0)]
    inner = J.questions_with_knowledge(q, link, know, "q", "k", F.col("subject") == 2, "inner")
    assert [r["q"] for r in inner.collect()] == [1]


def test_popularity_falls_back(spark):
    rows_ = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    train = spark.createDataFrame([("a",), ("a",)], "k string")
    test = spark.createDataFrame([("a",), ("b",)], "k string")
    got = {r["k"]: r["n"] for r in J.popularity(rows_, train, test, "k", "n").collect()}
    assert got == {"a": 2, "b": 1, "c": 0, None: 0}


def test_pairing_keeps_the_last_value(spark):
    left = spark.createDataFrame([("p", 1), ("q", 1), ("r", 2)], "pic string, slide int")
    right = spark.createDataFrame([(1, 0, "old"), (1, 3, "new")], "slide int, pos int, text string")
    got = rows(J.pair_within(left, right, "slide", "text", "pos").select("pic", "text"))
    assert got == [("p", "new"), ("q", "new")]


def test_summary_matches_numpy(spark):
    import numpy as np

    x = [1, 2, 2, 3, 4, 100]
    got = A.distribution_summary(spark.createDataFrame([(v,) for v in x], "x int"), "x").first().asDict()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    assert got["n"] == 6 and got["mean"] == pytest.approx(np.mean(x))
    assert (got["q1"], got["median"], got["q3"]) == (q1, med, q3)
    assert (got["whisker_low"], got["whisker_high"]) == (1, 4)


def test_auc_counts_ties_half(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (0, 0.5)]
    pos = [s for y, s in data if y]
    neg = [s for y, s in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = A.auc(spark.createDataFrame(data, "y int, s double"), "y", "s").first()["auc"]
    assert got == pytest.approx(want)


def test_dedup_top_and_last(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 1, "z"), (None, 9, "n"), (None, 3, "m")], "k string, o int, v string")
    assert sorted(r["v"] for r in A.dedup_first(df, ["k"], ["o"]).collect()) == ["m", "x", "z"]
    assert sorted(r["v"] for r in A.last_by(df, "k", "o", ["v"]).collect()) == ["n", "y", "z"]
    ranked = A.top_n(df, ["k"], [F.col("o").desc()], 1, "r")
    assert sorted(r["v"] for r in ranked.collect()) == ["n", "y", "z"]


def test_top_n_is_cut_before_the_shuffle(spark, capsys):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    A.top_n(df, ["k"], ["id"], 2).explain()
    assert "Partial" in capsys.readouterr().out


def test_scaling(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,)], "x double")
    assert [r["x"] for r in A.scale_unit(df, "x").orderBy("x").collect()] == [0.2, 0.6, 1.0]
    assert [r["b"] for r in A.mean_bucket(df, "x", "b").orderBy("x").collect()] == [1, 1, 2]
    assert [r["b"] for r in A.below_mean(df, "x", "b").orderBy("x").collect()] == [1, 0, 0]
    flat = A.standardize(spark.createDataFrame([(2.0,), (2.0,)], "x double"), ["x"])
    assert [r["x_std"] for r in flat.collect()] == [0.0, 0.0]


def test_hash_split_and_shuffle_repeat(spark):
    df = spark.range(1000)
    first, rest = A.hash_split(df, ["id"], 0.3)
    assert first.count() + rest.count() == 1000 and 230 < first.count() < 370
    assert first.intersect(rest).count() == 0
    again, _ = A.hash_split(df.repartition(8), ["id"], 0.3)
    assert rows(first) == rows(again)
    assert A.shuffle_rows(df, 1).collect() == A.shuffle_rows(df.repartition(5), 1).collect()


def test_user_skill_forms(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 2, 4), ("b", 1, 2), ("b", 2, 90)], "u string, i int, num int")
    ratio = {r["u"]: r["su"] for r in A.user_skill(df, "u", "num").collect()}
    scaled = {2: 1 / 3, 4: 1.0}
    assert ratio["a"] == pytest.approx(1.0 / ((scaled[2] + scaled[4]) / 2))
    assert ratio["b"] == pytest.approx((1 / 2) / scaled[2])
    smooth = {r["u"]: r["su"] for r in A.user_skill(df, "u", "num", "smoothed").collect()}
    raw = {"a": 3 / 4, "b": 3 / 47}
    low, high = min(raw.values()), max(raw.values())
    assert smooth == pytest.approx({u: (v - low + 1) / (high - low + 1) for u, v in raw.items()})


def test_last_before_by_bisection(spark):
    """Far more points than marks and the other way round, ties, nulls, copies, empty sides."""
    from bisect import bisect_right

    rnd = random.Random(5)
    for n_marks, n_points in ((5, 600), (600, 5), (80, 80), (0, 9), (9, 0)):
        marks = [(rnd.randrange(50) / 4, f"m{i}") for i in range(n_marks)] + [(None, "never")]
        points = [(i, rnd.choice([None, rnd.randrange(-20, 80) / 4])) for i in range(n_points)] + [(-1, None)] * 2
        m = spark.createDataFrame(marks, "at double, name string").repartition(7)
        p = spark.createDataFrame(points, "id int, at double").repartition(5)
        got = O.last_before(p, m, "at", "at").collect()
        starts = sorted(a for a, _ in marks if a is not None)
        want = []
        for i, at in points:
            n = 0 if at is None else bisect_right(starts, at)
            want.append((i, at, starts[n - 1] if n else None))
        assert sorted(((r.id, r.at, r.found.at if r.found else None) for r in got), key=repr) == sorted(want, key=repr)
        assert all(r.found is None or (r.found.at, r.found.name) in marks for r in got)
