import math
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.operators.sampling import permuted_place
from riffle.plans import affinity as AF
from riffle.plans import boost as B
from riffle.plans import embed as E
from riffle.plans import factor_blocks as FB
from riffle.plans import factors as M
from riffle.plans import linear as L
from riffle.plans import recommend as R
from riffle.plans import routes as T
from riffle.plans import rowwise as W
from riffle.plans.ratings import build_ratings
from riffle.plans import sweeps as SW
from riffle.plans.sweeps import sweep

RATINGS = np.array([[(u * 7 + i * 5 + u * i) % 6 if (u + 2 * i) % 3 else 0 for i in range(11)] for u in range(11)], dtype=float)


def long_ratings(spark, matrix=RATINGS):
    rows = [(int(u), int(i), float(matrix[u, i])) for u, i in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(rows, "user int, item int, rating double")


def start(kind, key, k):
    return ((key.cast("long") * 7 + (k + 1) * 5 + F.when(kind == "u", 1).otherwise(2)) % 10) / 10.0


def start_np(kind, n, k):
    return np.array([[((i * 7 + (j + 1) * 5 + (1 if kind == "u" else 2)) % 10) / 10.0 for j in range(k + 1)] for i in range(n)])


@pytest.mark.parametrize("form", M.FORMS)
def test_one_epoch_of_every_form(spark, form):
    k, alpha, beta = 3, 0.01, 0.02
    su = np.arange(1, 12) / 11
    p, q0 = start_np("u", 11, k)[:, :k], start_np("i", 11, k)
    q, si = q0[:, :k], q0[:, k]
    seen = RATINGS > 0
    extra = {"plain": 0, "product": np.outer(su, si), "sum": su[:, None] + si[None, :]}.get(form, 0)
    shift = {"inside_product": np.outer(su, si), "inside_sum": su[:, None] + si[None, :]}.get(form, np.zeros((11, 11)))
    inner = p[:, None, :] + shift[:, :, None]
    e = np.where(seen, RATINGS - (inner * q[None]).sum(2) - extra, 0)
    new_p = p + alpha * ((2 * e[:, :, None] * q[None]).sum(1) - beta * p * seen.sum(1)[:, None])
    new_q = q + alpha * ((2 * e[:, :, None] * inner).sum(0) - beta * q * seen.sum(0)[:, None])
    sums = {"plain": 0, "product": (2 * e * su[:, None]).sum(0), "sum": (2 * e).sum(0),
            "inside_product": (2 * e * su[:, None] * q.sum(1)[None]).sum(0), "inside_sum": (2 * e * q.sum(1)[None]).sum(0)}[form]
    new_si = si + (0 if form == "plain" else alpha * (sums - beta * si * seen.sum(0)))
    skill = spark.createDataFrame([(i, float(v)) for i, v in enumerate(su)], "user int, su double")
    model = M.factorize(long_ratings(spark), k, 1, alpha, beta, form=form, skill=skill, start=start)
    users = {int(r["u"]): [r[f"p{j}"] for j in range(k)] for r in model.side("u", "u", "p").collect()}
    items = {int(r["i"]): [r[f"q{j}"] for j in range(k)] + [r["q_bias"]] for r in model.side("i", "i", "q").collect()}
    assert np.allclose([users[i] for i in range(11)], new_p)
    assert np.allclose([items[i] for i in range(11)], np.column_stack([new_q, new_si]))


def test_loss_falls_and_salting_changes_nothing(spark):
    ratings = long_ratings(spark)
    plain = M.factorize(ratings, 3, 4, 0.01, start=start)
    salted = M.factorize(ratings, 3, 4, 0.01, start=start, rows_per_split=3)
    assert plain.losses == sorted(plain.losses, reverse=True)
    assert np.allclose(plain.losses, salted.losses)
    scored = M.predict_ratings(ratings, plain)
    assert A.rmse(scored, "rating", "estimate").first()[0] < np.std(RATINGS[RATINGS > 0]) * 2


def test_divergence_is_reported(spark):
    model = M.factorize(long_ratings(spark), 3, 30, 50.0, start=start)
    assert model.diverged


def test_sweep_equals_single_fits(spark):
    """Padded, stacked and salted cells of every form, ends at different epochs, shared trajectories."""
    r = long_ratings(spark)
    train, test = r.filter("(user + item) % 4 <> 0"), r.filter("(user + item) % 4 = 0")
    test = test.unionByName(spark.createDataFrame([(0, 999, 3.0), (None, 1, 2.0)], test.schema))
    skill = spark.createDataFrame([(i, (i + 1) / 11) for i in range(11)], "user int, su double")
    grid = [{"k": 2 + n % 3, "steps": s, "alpha": 0.01, "form": f} for n, f in enumerate(M.FORMS) for s in (0, 3)]
    grid += [
        {"k": 2, "steps": 5, "alpha": 50.0}, {"k": 2, "steps": 1, "alpha": 50.0}, {"k": 2, "steps": 20, "stop_below": 1e9},
        {"k": 4, "steps": 2, "alpha": 0.5, "per_rating": True, "clip": 0.01, "beta_bias": 0.3, "form": "sum"}, {"k": 2, "steps": 3, "alpha": 0.01},
    ]
    for rows_per_split in (3, 5_000_000):
        got = sweep(train, test, grid, skill=skill, start=start, rows_per_split=rows_per_split).collect()
        assert len(got) == len(grid)
        if rows_per_split == 3:
            salted = got
    for row, cell in zip(got, grid):
        model = M.factorize(train, skill=skill, start=start, **cell)
        scored = M.predict_ratings(test, model, skill=skill).filter("estimate is not null")
        assert (row.epochs, row.diverged, row.cold) == (len(model.losses), model.diverged, test.count() - scored.count())
        assert [row.first_loss, row.last_loss] == pytest.approx([model.losses[0], model.losses[-1]], nan_ok=True) if model.losses else row.first_loss is None
        assert row.rmse == pytest.approx(A.rmse(scored, "rating", "estimate").first()[0])
    assert [x.rmse for x in salted] == pytest.approx([x.rmse for x in got])
    assert sweep(train, test, []).count() == 0
    with pytest.raises(ValueError):
        sweep(train, test, [{"k": 2, "form": "sum"}])


def test_sweep_moves_wide_grids_in_groups(spark, monkeypatch):
    """What a cell gets at once is bounded, however many trajectories and ids there are; the figures stay."""
    r = long_ratings(spark)
    train, test = r.filter("(user + item) % 4 <> 0"), r.filter("(user + item) % 4 = 0")
    grid = [{"k": k, "steps": 2, "alpha": 0.01, "per_rating": k == 3} for k in (2, 3, 4)]
    want = sweep(train, test, grid, start=start).collect()
    sent, step = [], SW._cell_step
    monkeypatch.setattr(SW, "_cell_step", lambda cells, out: sent.append(sum(c.k for _, c in cells)) or step(cells, out))
    monkeypatch.setattr(SW, "_groups", lambda paths, moving, ids, f=SW._groups: f(paths, moving, SW.SENT_BYTES // (8 * 5)))
    got = sweep(train, test, grid, start=start).collect()
    assert set(sent) == {5, 4}
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[2:4] == pytest.approx(b[2:4]) and a.rmse == pytest.approx(b.rmse)


def test_ratings_from_logs(spark):
    logs = [spark.createDataFrame(d, "csr string, ke string") for d in ([("b", "k1"), ("b", "k1")], [("a", "k2")], [("b", "k2")] * 3)]
    got = sorted(map(tuple, build_ratings(logs, "csr", "ke", limit=3).collect()))
    assert got == [(0, 1, 1, 0.5), (1, 0, 2, 1.0)]


def brute_recommend(matrix, share, n, sim):
    u, s, vt = np.linalg.svd(matrix)
    k = int(np.argmax(np.cumsum(s**2) >= share * (s**2).sum())) + 1
    v = matrix.T @ u[:, :k] / s[:k]
    v = v * np.where(v.sum(axis=0) < 0, -1, 1)
    out = {}
    for user in range(matrix.shape[0]):
        scores = []
        for i in np.nonzero(matrix[user] == 0)[0]:
            top = bottom = 0.0
            for j in np.nonzero(matrix[user])[0]:
                if sim == "cosine":
                    w = 0.5 + 0.5 * v[i] @ v[j] / np.linalg.norm(v[i]) / np.linalg.norm(v[j])
                else:
                    w = 1.0 if k < 3 else 0.5 + 0.5 * np.corrcoef(v[i], v[j])[0, 1]
                top, bottom = top + w * matrix[user, j], bottom + w
            scores.append((i, top / bottom if bottom else 0.0))
        out[user] = sorted(scores, key=lambda x: (-x[1], x[0]))[:n]
    return k, v, out


@pytest.mark.parametrize("sim, per_block", [("cosine", 2048), ("cosine", 4), ("pearson", 5)])
def test_recommend_equals_brute_force(spark, sim, per_block):
    k, _, want = brute_recommend(RATINGS, 0.9, 3, sim)
    ratings = long_ratings(spark)
    got = R.recommend(ratings, 3, sim, 0.9, items_per_block=per_block, users_per_chunk=3)
    found = {}
    for r in got.orderBy("user", "rank").collect():
        assert RATINGS[r["user"], r["item"]] == 0
        found.setdefault(r["user"], []).append(r["estimate"])
    for user, items in want.items():
        assert np.allclose(found.get(user, []), [e for _, e in items], atol=1e-6)


def rank_two(seed=4):
    rnd = np.random.default_rng(seed)
    return np.rint(np.abs(rnd.normal(size=(40, 2)) @ rnd.normal(size=(2, 30)) * 3) + rnd.random((40, 30)))


@pytest.mark.parametrize("block", [3, 8, 30])
def test_steps_of_any_width_agree_with_exact_vectors(spark, block):
    m = rank_two()
    k, v, _ = brute_recommend(m, 0.9, 1, "cosine")
    got = {r["item"]: np.array(r["v"]) for r in R.item_factors(long_ratings(spark, m), 0.9, block=block).collect()}
    mine = np.array([got[i] for i in range(30)])
    assert mine.shape[1] == k
    assert np.allclose(mine @ mine.T, v @ v.T, atol=1e-5)


def test_rank_and_passes_bound_the_work(spark):
    m = rank_two()
    few = R.item_factors(long_ratings(spark, m), 1.0, max_rank=2, block=4)
    _, s, vt = np.linalg.svd(m)
    got = {r["item"]: np.array(r["v"]) for r in few.collect()}
    mine = np.array([got[i] for i in range(30)])
    assert np.allclose(mine @ mine.T, vt[:2].T @ vt[:2], atol=1e-6)
    whole, kept = R.kept_energy(long_ratings(spark, m), few)
    assert whole == pytest.approx((m**2).sum()) and kept == pytest.approx((s[:2] ** 2).sum(), rel=1e-9)
    with pytest.raises(ValueError, match="passes"):
        R.item_factors(long_ratings(spark, m), 0.999999, block=4, passes=1)
    rough = R.item_factors(long_ratings(spark, m), 0.5, block=4, passes=2)
    assert R.kept_energy(long_ratings(spark, m), rough)[1] >= 0.5 * whole
    none = long_ratings(spark, m).limit(0)
    assert R.item_factors(none).count() == 0 and R.recommend(none, 2, factors=few).count() == 0


def test_fewer_dimensions_than_items(spark):
    m = np.outer(np.arange(1, 7), np.arange(1, 13)).astype(float)
    got = R.item_factors(long_ratings(spark, m), 1.0, block=5).collect()
    assert all(len(r["v"]) == 1 for r in got)
    assert np.allclose(sorted(r["v"][0] for r in got), np.arange(1, 13) / np.linalg.norm(np.arange(1, 13)))


def clustered(spark, users=60, items=400, width=6):
    rnd = np.random.default_rng(8)
    centres = rnd.normal(size=(8, width))
    v = centres[np.arange(items) % 8] + 0.05 * rnd.normal(size=(items, width))
    factors = spark.createDataFrame([(i, v[i].tolist()) for i in range(items)], "item int, v array<double>")
    rows = [(u, int(i), float(1 + (u * 3 + i * 7) % 5)) for u in range(users) for i in rnd.choice(items, 3 + u % 5, replace=False)]
    return v, factors, rows, spark.createDataFrame(rows, "user int, item int, rating double")


def all_pairs(v, rows, n):
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = []
    for u in sorted({r[0] for r in rows}):
        mine = {i: r for w, i, r in rows if w == u}
        w = 0.5 + 0.5 * unit @ unit[list(mine)].T
        est = np.round(w @ np.array(list(mine.values())) / w.sum(axis=1), 9)
        best = sorted(((-e, i) for i, e in enumerate(est) if i not in mine))[:n]
        out += [(u, i, -e, k + 1) for k, (e, i) in enumerate(best)]
    return out


def test_search_skips_blocks_and_equals_all_pairs(spark):
    v, factors, rows, ratings = clustered(spark)
    got = R.recommend(ratings, 4, factors=factors, items_per_block=10, users_per_chunk=25)
    want = all_pairs(v, rows, 4)
    found = sorted(map(tuple, got.select("user", "item", "estimate", "rank").collect()), key=lambda r: (r[0], r[3]))
    assert [r[:2] + r[3:] for r in found] == [r[:2] + r[3:] for r in want]
    assert np.allclose([r[2] for r in found], [r[2] for r in want], atol=2e-9)
    unit = R._similarity_vectors(factors, "cosine")
    blocks = R.materialize(R.item_blocks(unit, 6, 10))
    sizes = [r["n"] for r in blocks.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect()]
    centres = R._centres(blocks, 6)
    home = R._best_blocks(R.user_profiles(ratings, unit, 6), centres)
    at = got.where("rank = 4").select("user", F.col("estimate").alias("_t"))
    asked = R._open_blocks(home.join(at, "user").select(*home.columns, "_t"), centres).count()
    assert sum(sizes) == 400 and asked < 0.5 * 60 * len(sizes)


def test_a_user_moves_once_per_group_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "GROUP_BLOCKS", 8)
    v, factors, rows, ratings = clustered(spark)
    unit = R._similarity_vectors(factors, "cosine")
    centres = R._centres(R.materialize(R.item_blocks(unit, 6, 4)), 6)
    home = R._best_blocks(R.user_profiles(ratings, unit, 6), centres)
    asked = R._open_blocks(home.withColumn("_t", F.lit(None).cast("double")), centres).collect()  # without a threshold all are open
    assert len(asked) <= 60 * (int(centres[0].max()) // 8 + 1)
    assert sum(bin(x).count("1") for r in asked for x in r["_open"]) == 60 * (len(centres[0]) - 1)
    for n in (2, 9):
        got = R.recommend(ratings, n, factors=factors, items_per_block=4, users_per_chunk=25)
        found = sorted(map(tuple, got.select("user", "item", "estimate", "rank").collect()), key=lambda r: (r[0], r[3]))
        assert [r[:2] + r[3:] for r in found] == [r[:2] + r[3:] for r in all_pairs(v, rows, n)]


def test_planes_put_like_items_together(spark):
    rows = [(i, [float(x) for x in np.eye(3)[i % 3] + i % 7]) for i in range(2100)]
    vectors = spark.createDataFrame(rows, "item int, v array<double>")
    blocks = R.materialize(R.item_blocks(vectors, 3, 20))
    _, _, radius = R._centres(blocks, 3)
    assert blocks.count() == 2100 and radius.max() < 1e-6 and len(radius) < 300  # 21 vectors, each in blocks of its own


def test_unknown_pairs_stay_and_any_similarity_can_be_used(spark):
    v, factors, rows, ratings = clustered(spark, 5, 30)
    asked = [(0, 1), (0, 999), (77, 1), (1, 2), (1, 2), (None, 3)]
    pairs = spark.createDataFrame([(*p, "x") for p in asked], "user int, item int, estimate string")
    got = [(r["user"], r["item"], r["estimate"]) for r in R.estimate_unrated(pairs, ratings, factors).collect()]
    assert sorted(r[:2] for r in got if r[0] is not None) == sorted(p for p in asked if p[0] is not None) and len(got) == 6
    assert all((e is None) == (u in (77, None) or i == 999) for u, i, e in got)

    def near(x, y):
        return 1 / (1 + np.linalg.norm(x - y, axis=1))

    by = {(r["user"], r["item"]): r["estimate"] for r in R.estimate_by(pairs, ratings, factors, near).collect()}
    for u, i in ((0, 1), (1, 2)):
        mine = [(j, r) for w, j, r in rows if w == u and j != i]
        s = near(v[[i] * len(mine)], v[[j for j, _ in mine]])
        assert by[u, i] == pytest.approx((s * [r for _, r in mine]).sum() / s.sum())
    assert by[0, 999] is None and by[77, 1] is None


def test_zeros_are_no_ratings_and_unknown_pairs_have_no_estimate(spark):
    ratings = spark.createDataFrame([(1, 1, 0.0), (1, 2, 5.0), (2, 2, 3.0)], "user int, item int, rating double")
    model = M.factorize(ratings, 2, 1)
    assert {(r["kind"], r["id"]) for r in model.table.collect()} == {("u", "1"), ("u", "2"), ("i", "2")}
    whole = M.factorize(ratings, 2, 1, keep="all")
    assert ("i", "1") in {(r["kind"], r["id"]) for r in whole.table.collect()}
    got = {(r["user"], r["item"]): r["estimate"] for r in M.predict_ratings(ratings, model).collect()}
    assert got[1, 1] is None and got[1, 2] is not None and len(got) == 3
    assert sweep(ratings, ratings, [{"k": 2, "steps": 1}]).first()["cold"] == 1
    nothing = ratings.limit(0)
    assert tuple(sweep(nothing, ratings, [{"k": 2, "steps": 1}]).first())[1:] == (1, 0.0, 0.0, False, None, 3)


def test_estimates_for_given_pairs(spark):
    _, _, want = brute_recommend(RATINGS, 0.9, 11, "cosine")
    ratings = long_ratings(spark)
    pairs = spark.createDataFrame([(u, int(i)) for u, s in want.items() for i, _ in s], "user int, item int")
    got = {(r["user"], r["item"]): r["estimate"] for r in R.estimate_unrated(pairs, ratings, R.item_factors(ratings, 0.9)).collect()}
    assert all(abs(got[(u, i)] - e) < 1e-6 for u, s in want.items() for i, e in s)


def _affinity_case(spark):
    pairs = {"genre": ("user", "genre", r"\|"), "tab": ("user", "tab", None), "city": ("city", "song", None)}
    rows = [
        (n % 7, n % 9, n % 3, ["x|y", "y", "", None, "z|x|x"][n % 5], ["a", "b", None][n % 3] if n % 4 else None, n % 5 if n % 6 else None, int(n % 4 == 1))
        for n in range(120)
    ]
    rows += [(None, 1, 1, "x", "a", 2, 1)] * 3 + [(1, 1, 1, "x|q", "a", 2, 0)] * 40
    return spark.createDataFrame(rows, "id int, user int, city int, genre string, tab string, song int, target int"), pairs


def test_affinity_pairs_are_made_distinct_where_they_are_stacked(spark):
    facts, pairs = _affinity_case(spark)
    want = set()
    for r in facts.collect():
        for name, (a, b, sep) in pairs.items():
            for right in ([] if r[b] is None else r[b].split("|") if sep else [str(r[b])]):
                if r[a] is not None:
                    want.add((name, str(r[a]), right, r["target"]))
    for rows_per_task in (5, 100_000):  # with hot keys and without
        got = AF.affinity_pairs(facts, pairs=pairs, rows_per_task=rows_per_task)
        found = [tuple(r) for r in got.select("pair", "left", "right", "target").collect()]
        assert len(found) == len(want) and set(found) == want
    plan = AF.affinity_pairs(facts, pairs=pairs)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")]


def test_affinity_features_do_not_stack_the_facts(spark):
    facts, pairs = _affinity_case(spark)
    model = AF.fit_affinity(facts.limit(60), pairs=pairs, k=2, epochs=2)
    sides = {}
    for kind, side in (("u", "left"), ("i", "right")):
        factors = {r["id"]: (r["f0"], r["f1"]) for r in model.factors.table.filter(F.col("kind") == kind).collect()}
        rows = getattr(model, side).collect()
        sides[side] = {(r["pair"], r[side]): (r[f"b_{side}"], factors[r["pair"] + "\u001f" + r[side]]) for r in rows}
    means = {r["pair"]: r["mu"] for r in model.means.collect()}
    for tags, fold in (("max", max), ("avg", lambda x: sum(x) / len(x))):
        found = {}
        for r in facts.collect():
            for name, (a, b, sep) in pairs.items():
                own = found.setdefault(r["id"], {n: [] for n in pairs})[name]
                for right in ([] if r[b] is None or r[a] is None else r[b].split("|") if sep else [str(r[b])]):
                    (x, p), (y, q) = sides["left"].get((name, str(r[a])), (0, (0, 0))), sides["right"].get((name, right), (0, (0, 0)))
                    own.append(min(1, max(0, means[name] + x + y + p[0] * q[0] + p[1] * q[1])))
        out = AF.affinity_features(facts, model, ["id"], pairs, tags=tags)
        assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: r for r in out.collect()}
        assert set(got) == set(found)
        for key, values in found.items():
            for name in pairs:
                want = fold(values[name]) if values[name] else means[name]
                assert got[key][f"aff_{name}"] == pytest.approx(want, abs=1e-9)


def test_affinity_range_unknown_ids_and_empty_rows(spark):
    rnd = random.Random(5)
    pairs = {"lang": ("msno", "lang", None), "genre": ("msno", "genre", r"\|")}
    rows = [(i, f"u{rnd.randint(0, 5)}", rnd.choice(["a", "b", None]), rnd.choice(["x|y", "y", "z", None]), rnd.randint(0, 1)) for i in range(200)]
    facts = spark.createDataFrame(rows, "id int, msno string, lang string, genre string, target int")
    stacked = AF.affinity_pairs(facts, pairs=pairs)
    assert stacked.count() == stacked.distinct().count() and stacked.filter("left is null or right is null").isEmpty()
    model = AF.fit_affinity(facts, pairs=pairs, k=2, epochs=3)
    asked = spark.createDataFrame([(1, "u1", "a", "x|y"), (2, "new", "a", None), (3, None, None, None)], "id int, msno string, lang string, genre string")
    got = AF.affinity_features(asked, model, ["id"], pairs).toPandas().set_index("id")
    assert len(got) == 3 and got.min().min() >= 0 and got.max().max() <= 1
    mu = {r["pair"]: r["mu"] for r in model.means.collect()}
    assert got.loc[3, "aff_lang"] == pytest.approx(mu["lang"])
    assert model.factors.losses[-1] < model.factors.losses[0]
    best = AF.affinity_features(asked, model, ["id"], pairs).toPandas().set_index("id").loc[1, "aff_genre"]
    mean = AF.affinity_features(asked, model, ["id"], pairs, tags="avg").toPandas().set_index("id").loc[1, "aff_genre"]
    assert best >= mean


def test_blend_ignores_what_is_not_positive(spark):
    df = spark.createDataFrame([(0.5, 0.0, None), (0.0, 0.0, 0.0), (0.2, 0.4, 0.6)], "a double, b double, c double")
    got = [r["target"] for r in AF.blend_estimates(df, ["a", "b", "c"], F.lit(0.3)).collect()]
    assert got == pytest.approx([0.5, 0.3, 0.4])


def points(spark, parts=3):
    rnd = random.Random(6)
    rows = [(rnd.gauss(2 * y, 0.5), rnd.gauss(-2 * y, 0.5), y) for y in (-1, 1) for _ in range(20)]
    return rows, spark.createDataFrame(rows, "a double, b double, y int").repartition(parts)


def test_batch_adaline_equals_numpy(spark):
    rows, df = points(spark)
    x = np.column_stack([np.ones(len(rows)), [r[0] for r in rows], [r[1] for r in rows]])
    y, w, cost = np.array([r[2] for r in rows], float), np.zeros(3), []
    for _ in range(5):
        e = y - x @ w
        w, cost = w + 0.001 * x.T @ e, [*cost, e @ e / 2]
    model = L.fit_linear(df, ["a", "b"], "y", eta=0.001, epochs=5)
    assert np.allclose(model.weights, w, atol=1e-9) and np.allclose(model.history, cost)
    wide = L._wide_gradient(df, model, "y", "adaline")
    assert np.allclose(wide[0], L.gradient(df, model, "y")[0]) and wide[1] == pytest.approx(L.gradient(df, model, "y")[1])


@pytest.mark.parametrize("kind", ["adaline", "perceptron"])
def test_row_updates_separate_two_classes(spark, kind):
    _, df = points(spark)
    model = L.fit_linear(df, ["a", "b"], "y", kind=kind, mode="mixing", epochs=10)
    assert A.accuracy(df.withColumn("p", model.predict()), "y", "p").first()[0] == 1.0
    again = L.fit_linear(df, ["a", "b"], "y", kind=kind, mode="mixing", epochs=10)
    assert np.allclose(model.weights, again.weights)


def as_dict(model):
    return {(r["kind"], r["id"]): [r[f"f{j}"] for j in range(model.k)] + [r["bias"]] for r in model.table.collect()}


@pytest.mark.parametrize("form, more", [*[(f, {}) for f in M.FORMS], ("sum", {"per_rating": True, "clip": 0.01})])
def test_cells_give_the_factors_of_the_rows(spark, form, more):
    ratings = long_ratings(spark)
    skill = spark.createDataFrame([(u, 0.5 + u / 20) for u in range(10)], "user int, su double")  # one user without skill
    more = {**more, "skill": None if form == "plain" else skill}
    rows = M.factorize(ratings, k=3, steps=2, form=form, alpha=0.01, **more)
    cells = FB.factorize_blocks(ratings, k=3, steps=2, form=form, alpha=0.01, cell_rows=5, **more)  # cells in pieces
    assert np.allclose(rows.losses, cells.losses)
    mine, want = as_dict(cells), as_dict(rows)
    assert mine.keys() == want.keys() and all(np.allclose(mine[key], want[key]) for key in want)


def test_fits_share_their_cells(spark, monkeypatch):
    ratings = long_ratings(spark)
    skill = spark.createDataFrame([(u, 0.5 + u / 20) for u in range(10)], "user int, su double")
    deals, deal = [], FB.deal_cells
    monkeypatch.setattr(FB, "deal_cells", lambda *a: deals.append(a) or deal(*a))
    with FB.dealt_ratings(ratings, skill) as dealt:
        fits = {f: FB.factorize_blocks(ratings, k=2, steps=1, form=f, alpha=0.01, skill=skill, dealt=dealt) for f in ("sum", "product")}
    assert len(deals) == 1
    for form, fit in fits.items():
        mine, want = as_dict(fit), as_dict(M.factorize(ratings, k=2, steps=1, form=form, alpha=0.01, skill=skill))
        assert mine.keys() == want.keys() and all(np.allclose(mine[key], want[key]) for key in want)
    with FB.dealt_ratings(ratings) as dealt, pytest.raises(ValueError):
        FB.factorize_blocks(ratings, k=2, form="sum", dealt=dealt)


def test_cells_hold_a_hot_user_repeats_and_nothing(spark):
    rows = [(0, i, 1.0 + i % 5) for i in range(300)] + [(u, u % 7, 2.0) for u in range(1, 60)] + [(3, 3, 2.0)] * 40 + [(None, 1, 3.0), (1, None, 3.0), (2, 2, None)]
    df = spark.createDataFrame(rows, "user int, item int, rating double")
    factors = M.initial_factors(M.training_rows(df, "plain", None, "user", "item", "rating", "positive"), 2, M.uniform_start(1))
    numbered = FB.global_index(factors, ["kind", "id"], "o")
    cells = FB.deal_cells(M.training_rows(df, "plain", None, "user", "item", "rating", "positive"), numbered, 20)
    sizes = cells.groupBy("cell").count().collect()
    assert sum(r["count"] for r in sizes) == 399 and max(r["count"] for r in sizes) <= 40
    clean = df.dropna()
    a, b = M.factorize(clean, k=2, steps=2), FB.factorize_blocks(clean, k=2, steps=2, cell_rows=20)
    assert np.allclose(a.losses, b.losses)
    none = FB.factorize_blocks(df.limit(0), k=2, steps=3)
    assert none.table.count() == 0 and none.losses == [0.0]
    with pytest.raises(ValueError):
        FB.factorize_blocks(clean, k=2, form="other")


def test_the_rarer_side_lies_in_one_cell(spark):
    df = spark.createDataFrame([(u, i, 1.0) for u in range(400) for i in range(3)], "user int, item int, rating double")
    rows = M.training_rows(df, "plain", None, "user", "item", "rating", "positive")
    factors = FB.global_index(M.initial_factors(rows, 2, M.uniform_start(1)), ["kind", "id"], "o")
    cells = FB.deal_cells(rows, factors, 400).select("uo", "io", "cell").collect()
    assert len(cells) == 1200 and len({(r["uo"], r["cell"]) for r in cells}) == 400 and len({r["cell"] for r in cells}) >= 5
    df = df.select(F.col("item").alias("user"), F.col("user").alias("item"), "rating")
    a, b = M.factorize(df, k=2, steps=2), FB.factorize_blocks(df, k=2, steps=2, cell_rows=100)
    mine, want = as_dict(b), as_dict(a)
    assert mine.keys() == want.keys() and all(np.allclose(mine[key], want[key]) for key in want)


def test_affinities_are_fitted_in_cells(spark, monkeypatch):
    facts, pairs = _affinity_case(spark)
    mine = as_dict(AF.fit_affinity(facts, pairs=pairs, k=2, epochs=2).factors)
    monkeypatch.setattr(AF, "factorize_blocks", M.factorize)
    want = as_dict(AF.fit_affinity(facts, pairs=pairs, k=2, epochs=2).factors)
    assert mine.keys() == want.keys() and all(np.allclose(mine[key], want[key]) for key in want)


def loop_over_rows(x, y, w, eta, kind="adaline"):
    """The plain loop: one update after the other; a row of weights per class."""
    w, cost = w.copy(), 0.0
    for xr, yr in zip(x, y, strict=True):
        net = w @ xr
        e = yr - (net if kind == "adaline" else np.where(net >= 0, 1.0, -1.0))
        cost += 0.5 * e @ e if kind == "adaline" else (e != 0).sum()
        w += eta * e[:, None] * xr[None, :]
    return w, cost


@pytest.mark.parametrize("kind", ["adaline", "perceptron"])
@pytest.mark.parametrize("epochs", [20, 40])
def test_block_updates_equal_the_loop(kind, epochs):
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(700), rng.normal(size=(700, 4))])
    y = np.where(rng.normal(size=(700, 3)) + x[:, 1:4] > 0, 1.0, -1.0)
    mine, want = np.zeros((3, 5)), np.zeros((3, 5))
    for _ in range(epochs):
        cost = W.update_rows(mine, x, y, kind, 0.01)
        want, wanted = loop_over_rows(x, y, want, 0.01, kind)
        assert cost == pytest.approx(wanted)
    assert np.allclose(mine, want, atol=1e-9)


@pytest.mark.parametrize("shuffle", [False, True])
def test_ordered_fit_equals_the_loop_over_all_rows(spark, shuffle):
    rng = np.random.default_rng(8)
    # many rows share a place in the order, and whole rows repeat
    rows = [(int(rng.integers(0, 40)), *[float(v) for v in np.round(rng.normal(size=2), 1)], int(rng.choice([-1, 1]))) for _ in range(900)]
    rows += rows[:150]
    df = spark.createDataFrame(rows + [(1, None, 0.5, 1), (2, 0.5, 0.5, None)], "k long, a double, b double, y int").repartition(7)
    model = L.fit_linear(df, ["a", "b"], "y", mode="ordered", order=["k"], eta=0.01, epochs=20, shuffle=shuffle, seed=3)
    ordered = np.array(sorted(rows), dtype=float)
    w, costs = np.zeros((1, 3)), []
    for e in range(20):
        turn = np.arange(len(ordered))
        if shuffle:
            places = spark.range(len(ordered)).select("id", permuted_place(F.col("id"), len(ordered), 3 + e).alias("p")).collect()
            turn = np.array([r["id"] for r in sorted(places, key=lambda r: r["p"])])
        z = ordered[turn]
        w, cost = loop_over_rows(np.column_stack([np.ones(len(z)), z[:, 1:3]]), z[:, 3:], w, 0.01)
        costs.append(cost / len(z))
    assert np.allclose(model.weights, w[0], atol=1e-9) and np.allclose(model.history, costs)


def test_ordered_fit_over_many_ranges_and_none(spark):
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")  # three levels of maps
    try:
        df = spark.range(3000).select("id", (F.col("id") % 17 / 17).alias("a"), F.when(F.col("id") % 5 < 2, 1).otherwise(-1).alias("y"))
        model = L.fit_linear(df, ["a"], "y", mode="ordered", order=["id"], eta=0.05, epochs=3)
        empty = L.fit_linear(df.limit(0), ["a"], "y", mode="ordered", order=["id"], start=np.array([1.0, 2.0]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    x = np.column_stack([np.ones(3000), np.arange(3000) % 17 / 17])
    y, w = np.where(np.arange(3000) % 5 < 2, 1.0, -1.0)[:, None], np.zeros((1, 2))
    for _ in range(3):
        w, _ = loop_over_rows(x, y, w, 0.05)
    assert np.allclose(model.weights, w[0], atol=1e-9)
    assert list(empty.weights) == [1.0, 2.0] and empty.history == []
    with pytest.raises(ValueError):
        L.fit_linear(df, ["a"], "y", kind="perceptron", mode="ordered", order=["id"])


def test_one_vs_rest(spark):
    rnd = random.Random(7)
    centres = {"p": (0, 4), "q": (4, -3), "r": (-4, -3)}
    rows = [(rnd.gauss(c[0], 0.4), rnd.gauss(c[1], 0.4), s) for s, c in centres.items() for _ in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, s string")
    model = L.fit_one_vs_rest(df, ["a", "b"], "s", epochs=20)
    assert A.accuracy(df.withColumn("p", model.predict()), "s", "p").first()[0] == 1.0


@pytest.mark.parametrize("rule", [L.sgd(0.95), L.momentum(0.1), L.nesterov(0.1), L.adagrad(1.5), L.rmsprop(0.1), L.adam(0.3)])
def test_rules_go_down_a_bowl(rule):
    at, state = np.array([-7.0, 2.0]), {}
    first = at[0] ** 2 / 20 + at[1] ** 2
    for _ in range(60):
        at = at + rule(np.array([at[0] / 10, 2 * at[1]]), state)
    assert at[0] ** 2 / 20 + at[1] ** 2 < first / 5


def test_nesterov_velocity_flag():
    g = np.array([1.0])
    assert L.nesterov(0.1)(g, {})[0] == pytest.approx(-0.19)
    assert L.nesterov(0.1, new_velocity=True)(g, {})[0] == pytest.approx(-0.081 - 0.19)


def test_tours(spark):
    routes = spark.createDataFrame([(r, p, s) for r, stops in {"x": "abc", "y": "abd", "z": "a"}.items() for p, s in enumerate(stops)], "route string, pos int, stop string")
    dist = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 2.0), ("c", "a", 4.0), ("b", "d", 1.0), ("a", "a", 0.5)], "a string, b string, d double")
    lengths = T.tour_length(routes, dist)
    assert {r["route"]: r["length"] for r in lengths.collect()} == {"x": 7.0, "y": float("inf"), "z": 0.5}
    scored = T.fitness(lengths)
    assert [r["route"] for r in T.rank_routes(scored).orderBy("rank").collect()] == ["z", "x", "y"]
    assert [r["route"] for r in T.elite(scored, 1).collect()] == ["z"]


def test_roulette_hits_the_holding_interval(spark):
    weights = [(0, 1000.0), (1, 0.0), (2, 1.0), (3, 2.5), (4, 500.0)]
    df = spark.createDataFrame(weights, "id int, w double")
    picks = T.random_picks(spark, 300, 9).unionByName(spark.createDataFrame([(900, 0.0), (901, 0.9999999)], "pick_id long, pick double"))
    got = {r["pick_id"]: (r["pick"], r["id"]) for r in T.roulette_sample(df, "w", ["id"], picks).collect()}
    assert len(got) == 302
    ends = np.cumsum([w for _, w in weights]) / sum(w for _, w in weights)
    assert all(i == int(np.searchsorted(ends, p, side="right")) for p, i in got.values())


def test_boosted_trees_and_best_per_id(spark):
    rnd = random.Random(8)
    rows = [(i // 2, rnd.random(), rnd.choice(["a", "b", None]), None if i % 9 == 0 else 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, x double, c string, n double").withColumn("y", (F.col("x") > 0.5).cast("int"))
    model = B.fit_gbt(df, "y", ["x", "n"], ["c"], rounds=3, depth=3)
    scored = B.score(model, df)
    assert A.auc(scored, "y", "score").first()["auc"] > 0.95
    assert B.best_per_id(scored, "id", "score").count() == 200


def test_wide_categories_are_coded_without_their_own_label(spark):
    rnd = random.Random(3)
    odds = {i: rnd.random() for i in range(300)}
    rows = [(k, f"v{i}" if i else None, int(rnd.random() < odds[i])) for k in range(4000) for i in [rnd.randrange(300)]]
    df = spark.createDataFrame(rows, "id int, c string, y int")
    out, codes = B.ordered_target_codes(df.repartition(5), ["c"], "y", ["id"], weight=2.0, seed=4)
    prior = sum(r[2] for r in rows) / len(rows)
    seen, want = {}, {}
    for k, c, y in sorted(rows, key=lambda r: hashlib.md5(f"4|{r[0]}".encode()).hexdigest()):
        n, s = seen.get(c, (0, 0))
        want[k] = (s + 2 * prior) / (n + 2)
        seen[c] = (n + 1, s + y)
    assert {r["id"]: pytest.approx(r["c_code"]) for r in out.collect()} == want
    later = B.coded(spark.createDataFrame([("v1",), ("never",), (None,)], "c string"), codes)
    got = {r["c"]: r["c_code"] for r in later.collect()}
    means = {c: (s + 2 * prior) / (n + 2) for c, (n, s) in seen.items()}
    assert got == {"v1": pytest.approx(means["v1"]), "never": pytest.approx(prior), None: pytest.approx(means[None])}


def test_trees_learn_from_a_wide_category_and_are_judged_on_other_rows(spark):
    rnd = random.Random(5)
    rows = [(k, i, int(rnd.random() < (0.9 if i % 2 else 0.1))) for k in range(3000) for i in [rnd.randrange(60)]]
    df = spark.createDataFrame(rows, "id int, c int, y int")
    train, test = df.where("id % 3 > 0"), df.where("id % 3 = 0")
    model = B.fit_gbt(train, "y", [], ["c"], rounds=3, depth=3, bins=32, order=["id"])
    assert model.codes.columns == ("c",) and B.holdout_auc(model, test, "y") > 0.8
    assert B.holdout_auc(model, test.where("y = 1"), "y") is None


def test_embeddings(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, "c")], "id int, t string")
    assert {len(r["vector"]) for r in E.embed_column(df, "t", size=32).collect()} == {32}
    own = E.embed_column(df, "t", encoder=lambda s: np.array([[len(v), 1.0] for v in s]), size=2)
    assert {r["id"]: list(r["vector"]) for r in own.collect()} == {1: [5.0, 1.0], 2: [0.0, 1.0], 3: [1.0, 1.0]}
    both = E.combine_vectors(own.withColumn("w", F.array(F.lit(9.0).cast("float"))), ["vector", "w"])
    assert both.filter("id = 1").first()["combined"] == [5.0, 1.0, 9.0]


def test_trees_read_few_rows_a_task(spark, monkeypatch):
    """Cached training rows grow with the table, so their tasks must grow in number; the setting comes back."""
    seen, fit, name = [], B.Pipeline.fit, "spark.sql.files.maxPartitionBytes"

    def spy(self, df):
        seen.extend(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
        return fit(self, df)

    monkeypatch.setattr(B, "ROWS_PER_TASK", 40)
    monkeypatch.setattr(B.Pipeline, "fit", spy)
    before = spark.conf.get(name)
    df = spark.range(0, 600, 1, 2).selectExpr("id % 7 as x", "cast(id % 7 > 3 as int) as y")
    model = B.fit_gbt(df, "y", ["x"], rounds=1, depth=2)
    assert sum(seen) == 600 and max(seen) <= 40
    assert spark.conf.get(name) == before
    assert B.score(model, df).where("(score > 0.5) = (y = 1)").count() == 600


def test_target_codes_move_marks_of_sixteen_bytes(spark, monkeypatch):
    written, write = [], B.materialize
    monkeypatch.setattr(B, "materialize", lambda df, *a: written.append(dict(df.dtypes)) or write(df, *a))
    df = spark.range(20).selectExpr("id", "id % 3 as a", "id % 2 as b", "cast(id % 5 = 0 as int) as y")
    out, _ = B.ordered_target_codes(df, ["a", "b"], "y", ["id"])
    assert out.columns == ["id", "a", "b", "y", "a_code", "b_code"]
    assert {t["_mark"] for t in written if "_mark" in t} == {"binary"}
    assert all("_mark" not in t for t in written if "b_code" in t)


def test_sweep_holds_one_row_an_id(spark):
    """All trajectories of an id lie in one row, each as wide as its own factors; cells stay few."""
    rows = M.training_rows(long_ratings(spark), "plain", None, "user", "item", "rating", "positive")
    paths = [SW._Path(SW.Cell(k, form=form), {1}) for k, form in ((2, "plain"), (5, "plain"), (3, "sum"))]
    table = SW._start_table(rows, paths, start).cache()
    assert table.count() == rows.select("u").distinct().count() + rows.select("i").distinct().count()
    assert len(table.columns) == 3 + 2 + 5 + 3 + 1
    least = int(spark.conf.get("spark.sql.shuffle.partitions")) // 2
    with FB.open_cells(rows, table, SW.ROWS_PER_SPLIT, least) as (held, _):
        assert held.select("cell").distinct().count() <= math.ceil(math.sqrt(max(least, 1))) ** 2
