"""Exact k-means: against a plain loop, ties, odd rows, and how few centroids are compared."""

import hashlib

import numpy as np
import pytest
from oracle import connect, rows_of

from riffle.llm import centroids as C

SF = "/root/testdata/sf0.001"


def plain(ids, x, k, rounds, seed="1"):
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"{seed}:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), x[i]))
    c = [list(x[i]) for i in order[:k]]
    for step in range(rounds + 1):
        d = [[sum((a - b) ** 2 for a, b in zip(v, y)) for y in c] for v in x]
        own = [min(range(len(c)), key=lambda j: (r[j], j)) for r in d]
        if step < rounds:
            for j in range(len(c)):
                members = [x[i] for i in range(len(x)) if own[i] == j]
                if members:
                    c[j] = [sum(m) // len(members) for m in zip(*members)]
    return own, [r[j] for r, j in zip(d, own)], c


def run(spark, rows, k, rounds, dims, scale=1):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out, c = C.cluster(df.repartition(3), k, rounds, dims=dims, scale=scale)
    return out, c.tolist()


@pytest.mark.parametrize("k,rounds,spread", [(1, 2, 5), (2, 3, 2), (5, 4, 3), (16, 3, 40), (30, 5, 1)])
def test_equals_plain_loop_with_many_ties(spark, k, rounds, spread):
    rng = np.random.default_rng(k)
    x = rng.integers(-spread, spread + 1, (120, 3)).tolist()
    x[60:80] = [x[0]] * 20
    out, c = run(spark, [(i, [float(e) for e in v]) for i, v in enumerate(x)], k, rounds, 3)
    own, d, want = plain(range(len(x)), x, k, rounds)
    assert c == want
    assert sorted(map(tuple, out.collect())) == sorted(zip(range(len(x)), own, d))


def test_rows_that_are_not_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (None, [3.0, 4.0]), (7, [-0.0, 1e-9])]
    bad = [(2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [1.0, nan]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [-inf, 0.0])]
    df = spark.createDataFrame([(*r, "c") for r in good + bad], "vec_id long, embedding array<double>, cluster string")
    out, c = C.cluster(df, 2, 1, dims=2, scale=64)
    assert out.columns == ["vec_id", "cluster", "distance"]
    assert sorted(r.vec_id or 0 for r in out.collect()) == [0, 1, 1, 7]
    x = [[32, -32], [32, -32], [192, 256], [0, 0]]
    own, d, want = plain([1, 1, None, 7], x, 2, 1)
    assert c.tolist() == want and sorted(r.distance for r in out.collect()) == sorted(d)
    none, c = C.cluster(df.limit(0), 2, 1, dims=2)
    assert none.count() == 0 and c.shape == (0, 2) and none.columns == ["vec_id", "cluster", "distance"]
    few, c = C.cluster(df.where("vec_id = 7"), 5, 3, dims=2)
    assert [tuple(r) for r in few.collect()] == [(7, 0, 0)] and len(c) == 1


def test_values_too_wide_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        C.cluster(df, 2, 1, dims=2)


def test_widest_values_stay_exact(spark):
    most = int((2**61 // 2) ** 0.5) - 8
    x = [[most, -most], [-most, most], [most - 1, -most], [most - 3, 3 - most], [0, 0]]
    out, c = run(spark, [(i, [float(e) for e in v]) for i, v in enumerate(x)], 3, 2, 2)
    own, d, want = plain(range(5), x, 3, 2)
    assert c == want and sorted(map(tuple, out.collect())) == sorted(zip(range(5), own, d))


def test_bounds_spare_most_comparisons():
    rng = np.random.default_rng(3)
    mid = rng.integers(-1000, 1000, (40, 16))
    x = (mid[rng.integers(0, 40, 4000)] + rng.integers(-20, 21, (4000, 16))).astype(np.int64)
    c = mid.astype(np.int64)
    first = C.Search(c)
    state = first.assign(x, np.zeros(4000, int), np.ones(4000, int), np.full(4000, np.inf), np.full(4000, -np.inf))
    new = np.array([x[state[0] == j].sum(0) // max(1, (state[0] == j).sum()) for j in range(40)])
    moved = np.sqrt(((new - c) ** 2).sum(1)) * (1 + C.SLACK)
    second = C.Search(new, moved)
    cluster = second.assign(x, *state)[0]
    d = ((x[:, None] - new[None]) ** 2).sum(2)
    assert (cluster == d.argmin(1)).all() and second.compared < 4000 * 2


def test_query_equals_sql(spark):
    out = C.centroid_clusters(spark, SF)
    res = connect(SF).execute(C._oracle())
    assert rows_of(out.columns, out.collect()) == rows_of([d[0] for d in res.description], res.fetchall())
