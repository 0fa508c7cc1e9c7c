"""Affinities, factor models, recommendations, linear models, boosted trees, the stream."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from riffle.operators import aggregates as A
from riffle.plans import affinity as AF
from riffle.plans import boost as B
from riffle.plans import factor_blocks as FB
from riffle.plans import factors as M
from riffle.plans import linear as L
from riffle.plans.ratings import build_ratings
from riffle.plans.recommend import estimate_by, estimate_unrated, item_factors, kept_energy, recommend
from riffle.plans.sparse import MEMBER_ORDER, SONG_ORDER, export_affinity_features
from riffle.plans.sweeps import sweep
from riffle.queries import standin as S
from riffle.queries.registry import query, table
from riffle.queries.relational import PAIR_COUNTS, log_rows
from riffle.session import materialize, shared_folder
from riffle.streaming.partial_fit import partial_fit_stream, weights_by_batch

DAMPING = 10.0


def affinity_facts(spark, sf):
    """Wide rows with the two-way length bucket, in the columns that affinities need; written once, since the mean, the fit and the
    scores all read them."""
    paired = [c for a, b, _ in AF.PAIRS.values() for c in (a, b) if c != "length_bucket"]
    needed = dict.fromkeys([*S.ID, "l_linestatus", "target", "song_length", *paired])
    return A.mean_bucket(materialize(S.wide_rows(spark, sf).select(*needed)), "song_length", "length_bucket")


def _right(c: str, sep: str | None) -> str:
    if sep is None:
        return f"[cast({c} as varchar)]"
    return f"string_split({c}, '|')" if sep == AF.GENRE_SEP else f"regexp_split_to_array({c}, '[/\\\\;|&]')"


def _stack(source: str, keep: str) -> str:
    parts = [
        f"select {keep}, '{n}' as pair, cast({a} as varchar) as l, unnest({_right(b, sep)}) as r from {source}"
        for n, (a, b, sep) in AF.PAIRS.items()
    ]
    return f"select * from ({' union all '.join(parts)}) where l is not null and r is not null"


AFFINITY = f"""
w as (select *, case when song_length <= (select avg(song_length) from wide) then 1 when song_length is not null then 2 end as length_bucket from wide),
train as (select * from w where l_linestatus = 'F'), test as (select * from w where l_linestatus = 'O'),
rows_ as (select distinct pair, l, r, target from ({_stack('train', 'target')})),
mu as (select pair, avg(target) as mu from rows_ group by pair),
bl as (select pair, l, (sum(target) - count(*) * any_value(mu)) / (count(*) + {DAMPING}) as bl from rows_ join mu using (pair) group by pair, l),
br as (select pair, r, (sum(target) - count(*) * any_value(mu)) / (count(*) + {DAMPING}) as br from rows_ join mu using (pair) group by pair, r)
"""
ESTIMATES = f"""
est as (select {', '.join(S.ID)}, pair, greatest(0.0, least(1.0, mu + coalesce(bl, 0) + coalesce(br, 0))) as e
  from ({_stack('test', ', '.join(S.ID))}) join mu using (pair) left join bl using (pair, l) left join br using (pair, r)),
wide_est as (select {', '.join(S.ID)}, {', '.join(f"coalesce(max(case when pair = '{n}' then e end), (select mu from mu where pair = '{n}')) as aff_{n}" for n in AF.PAIRS)}
  from test left join est using ({', '.join(S.ID)}) group by all),
mean_est as (select {', '.join(S.ID)}, {', '.join(f"coalesce(avg(case when pair = '{n}' then e end), (select mu from mu where pair = '{n}')) as aff_{n}" for n in AF.PAIRS)}
  from test left join est using ({', '.join(S.ID)}) group by all)
"""


@query(f"""with {S.SQL}, {AFFINITY} select pair, l as "left", r as "right", target from rows_""")
def affinity_pairs(spark, sf):
    train, _ = S.split(affinity_facts(spark, sf))
    return AF.affinity_pairs(train)


@query(f"""with {S.SQL}, {AFFINITY} select 'left' as side, pair, l as key, round(mu, 6) as mu, round(bl, 6) as b from bl join mu using (pair)
union all select 'right', pair, r, round(mu, 6), round(br, 6) from br join mu using (pair)""")
def affinity_baseline(spark, sf):
    train, _ = S.split(affinity_facts(spark, sf))
    model = AF.fit_affinity(train, k=0, damping=DAMPING)

    def side(name):
        return getattr(model, name).join(model.means, "pair").select(
            F.lit(name).alias("side"), "pair", F.col(name).alias("key"), F.round("mu", 6).alias("mu"), F.round(f"b_{name}", 6).alias("b")
        )

    return side("left").unionByName(side("right"))


@query(f"""with {S.SQL}, {AFFINITY}, {ESTIMATES}, n as (select *, {' + '.join(f'case when aff_{n} > 0 then 1 else 0 end' for n in AF.PAIRS)} as n,
 {' + '.join(f'greatest(aff_{n}, 0)' for n in AF.PAIRS)} as s from wide_est)
select {', '.join(S.ID)}, round(case when n > 0 then s / n else (select avg(target) from train) end, 6) as target from n""")
def blend_baseline(spark, sf):
    train, test = S.split(affinity_facts(spark, sf))
    model = AF.fit_affinity(train, k=0, damping=DAMPING)
    features = AF.affinity_features(test, model, S.ID)
    mean = train.agg(F.avg("target")).scalar()
    out = AF.blend_estimates(features, [f"aff_{n}" for n in AF.PAIRS], mean)
    return out.select(*S.ID, F.round("target", 6).alias("target"))


@query(f"""with {S.SQL}, {AFFINITY}, {ESTIMATES} select {', '.join(S.ID)}, 0 as target, 0 as gnum, 5 as unum, 11 as inum,
{', '.join(f"concat('{i}:', printf('%.5f', aff_{n})) as {n}" for i, n in enumerate(MEMBER_ORDER, 1))},
{', '.join(f"concat('{i}:', printf('%.5f', aff_{n})) as {n}" for i, n in enumerate(SONG_ORDER, 1))} from mean_est""")
def dense_features(spark, sf):
    train, test = S.split(affinity_facts(spark, sf))
    model = AF.fit_affinity(train, k=0, damping=DAMPING)
    means = AF.affinity_features(test, model, S.ID, tags="avg")
    return export_affinity_features(means, F.lit(0), keep=S.ID, digits=5)


@query()
def affinity_features(spark, sf):
    train, test = S.split(affinity_facts(spark, sf))
    model = AF.fit_affinity(train, k=8, epochs=3)
    return AF.affinity_features(test, model, S.ID)


def arithmetic_start(kind, key, k):
    """Start values both engines can compute from the id."""
    return ((key.cast("long") * 7919 + (k + 1) * 104729) % 1000) / 1000.0


def _start(key: str, j: int) -> str:
    return f"(({key} * 7919 + {j} * 104729) % 1000) / 1000.0"


@query(f"""with {PAIR_COUNTS},
j as (select u, i, rating, {_start('u', 1)} as p1, {_start('u', 2)} as p2, {_start('u', 3)} as p3,
  {_start('i', 1)} as q1, {_start('i', 2)} as q2, {_start('i', 3)} as q3 from kept),
e as (select *, rating - (p1 * q1 + p2 * q2 + p3 * q3) as e from j)
select 'u' as kind, u as id, {', '.join(f'round(any_value(p{n}) + 0.0002 * sum(2 * e * q{n} - 0.002 * p{n}), 6) as f{n - 1}' for n in (1, 2, 3))} from e group by u
union all select 'i', i, {', '.join(f'round(any_value(q{n}) + 0.0002 * sum(2 * e * p{n} - 0.002 * q{n}), 6) as f{n - 1}' for n in (1, 2, 3))} from e group by i""")
def factor_epoch(spark, sf):
    ratings = build_ratings([log_rows(spark, sf)], "user", "item", encode=False)
    model = M.factorize(ratings, k=3, steps=1, start=arithmetic_start)
    return model.table.select("kind", F.col("id").cast("long").alias("id"), *[F.round(f"f{j}", 6).alias(f"f{j}") for j in range(3)])


_SHIFT = {"product": "0.0", "sum": "0.0", "inside_product": "su * si", "inside_sum": "(su + si)"}
_OUTSIDE = {"product": "su * si", "sum": "su + si", "inside_product": "0.0", "inside_sum": "0.0"}
_BIAS_PULL = {"product": "2 * e * su", "sum": "2 * e", "inside_product": "2 * e * su * (q1 + q2 + q3)", "inside_sum": "2 * e * (q1 + q2 + q3)"}


def _form_sql(form: str) -> str:
    """One full-batch epoch of a skill-aware form."""
    sh = _SHIFT[form]
    est = " + ".join(f"(p{n} + {sh}) * q{n}" for n in (1, 2, 3))
    err = f"(select *, rating - ({est} + {_OUTSIDE[form]}) as e from js)"
    users = ", ".join(f"round(any_value(p{n}) + 0.0002 * sum(2 * e * q{n} - 0.002 * p{n}), 6) as f{n - 1}" for n in (1, 2, 3))
    items = ", ".join(f"round(any_value(q{n}) + 0.0002 * sum(2 * e * (p{n} + {sh}) - 0.002 * q{n}), 6)" for n in (1, 2, 3))
    bias = f"round(any_value(si) + 0.0002 * sum({_BIAS_PULL[form]} - 0.002 * si), 6)"
    return (
        f"select '{form}' as form, 'u' as kind, u as id, {users}, 0.0 as bias from {err} group by u "
        f"union all select '{form}', 'i', i, {items}, {bias} from {err} group by i"
    )


@query(f"""with {PAIR_COUNTS},
sk as (select u, (count(*) + 1.0) / (avg(num) + 1) as x from pairs group by u),
su as (select u, (x - (select min(x) from sk) + 1) / ((select max(x) from sk) - (select min(x) from sk) + 1) as su from sk),
js as (select kept.u, i, rating, su, {_start('i', 4)} as si, {_start('kept.u', 1)} as p1, {_start('kept.u', 2)} as p2, {_start('kept.u', 3)} as p3,
  {_start('i', 1)} as q1, {_start('i', 2)} as q2, {_start('i', 3)} as q3 from kept join su on kept.u = su.u)
{' union all '.join(_form_sql(f) for f in _SHIFT)}""")
def factor_epoch_forms(spark, sf):
    """One epoch of each skill-aware form from arithmetic start values."""
    counts = A.interaction_counts(log_rows(spark, sf), "user", "item")
    ratings = materialize(build_ratings([log_rows(spark, sf)], "user", "item", encode=False))
    skill = materialize(A.user_skill(counts, "user", "num", "smoothed"))
    parts = []
    for form in _SHIFT:
        model = M.factorize(ratings, k=3, steps=1, form=form, skill=skill, start=arithmetic_start)
        parts.append(
            model.table.select(
                F.lit(form).alias("form"), "kind", F.col("id").cast("long").alias("id"),
                *[F.round(c, 6).alias(c) for c in ("f0", "f1", "f2", "bias")],
            )
        )
    return reduce(lambda a, b: a.unionByName(b), parts)


_TEST_PART = "(u * 31 + i * 17) % 10 = 0"


def _two_parts(spark, sf):
    ratings = materialize(build_ratings([log_rows(spark, sf)], "user", "item", encode=False))
    held = (F.col("user") * 31 + F.col("item") * 17) % 10 == 0
    return ratings, ratings.filter(~held), ratings.filter(held)


def _walk_sql(name: str, k: int, steps: int, beta: float, form: str = "plain", clip: float | None = None) -> tuple[list[str], list[str]]:
    """CTEs of ``steps`` full-batch epochs of one cell on ``tr`` (u, i, r, su), and selects of its figures after each."""
    sh, out = ("0.0", "0.0") if form == "plain" else (_SHIFT[form], _OUTSIDE[form])
    pull = "0.0" if form == "plain" else f"{_BIAS_PULL[form]} - {beta} * si".replace("(q1 + q2 + q3)", "(" + " + ".join(f"q{n}" for n in range(1, k + 1)) + ")")
    est = " + ".join(f"(p{n} + {sh}) * q{n}" for n in range(1, k + 1)) + f" + {out}"
    names = range(1, k + 1)

    def step(x: str) -> str:
        x = f"0.0002 * sum({x})"
        return x if clip is None else f"greatest(-{clip}, least({clip}, {x}))"

    parts = [
        f"{name}p0 as (select u, {', '.join(f'{_start("u", n)} as p{n}' for n in names)} from tr group by u)",
        f"{name}q0 as (select i, {_start('i', k + 1)} as si, {', '.join(f'{_start("i", n)} as q{n}' for n in names)} from tr group by i)",
    ]
    for t in range(steps):
        parts += [
            f"{name}e{t} as (select *, r - ({est}) as e from tr join {name}p{t} using (u) join {name}q{t} using (i))",
            f"{name}l{t} as (select sum(e * e + {beta} / 2 * ({' + '.join(f'p{n} * p{n} + q{n} * q{n}' for n in names)})) as loss from {name}e{t})",
            f"{name}p{t + 1} as (select u, {', '.join(f'any_value(p{n}) + ' + step(f'2 * e * q{n} - {beta} * p{n}') + f' as p{n}' for n in names)} from {name}e{t} group by u)",
            f"{name}q{t + 1} as (select i, any_value(si) + {step(pull)} as si, "
            + ", ".join(f"any_value(q{n}) + {step(f'2 * e * (p{n} + {sh}) - {beta} * q{n}')} as q{n}" for n in names) + f" from {name}e{t} group by i)",
        ]
    figures = [
        f"{t} as epochs, round((select loss from {name}l0), 3) as first_loss, round((select loss from {name}l{t - 1}), 3) as last_loss, false as diverged, "
        f"(select round(sqrt(avg((r - ({est})) * (r - ({est})))), 6) from te join {name}p{t} using (u) join {name}q{t} using (i)) as rmse, "
        f"(select count(*) from te) - (select count(*) from te join {name}p{t} using (u) join {name}q{t} using (i) where su is not null) as cold"
        for t in range(1, steps + 1)
    ]
    return parts, figures


def _grid_sql(grid: list[dict]) -> str:
    """Figures of all cells; cells that differ in steps alone share their CTEs."""
    walks: dict[tuple, list[int]] = {}
    for cell in grid:
        walks.setdefault(tuple(sorted((k, v) for k, v in cell.items() if k != "steps")), []).append(cell["steps"])
    parts, rows = [], []
    for n, (settings, steps) in enumerate(walks.items()):
        cell = dict(settings)
        ctes, figures = _walk_sql(f"w{n}", cell["k"], max(steps), cell.get("beta", 0.002), cell.get("form", "plain"), cell.get("clip"))
        parts += ctes
        for s in steps:
            text = ", ".join(f"{k}={v}" for k, v in sorted({**cell, "steps": s}.items()))
            rows.append(f"select '{text}' as cell, {figures[s - 1]}")
    return ",\n".join(parts) + "\n" + "\nunion all ".join(rows)


def _rounded(cells):
    return cells.withColumns({"first_loss": F.round("first_loss", 3), "last_loss": F.round("last_loss", 3), "rmse": F.round("rmse", 6)})


FORM_GRID = [{"k": 3, "steps": s, "form": f, "clip": 1.0} for f in M.FORMS for s in (1, 3)]
GRID = [{"k": k, "steps": s, "beta": b} for k in (3, 5, 8, 10) for s in (1, 2, 4) for b in (0.002, 0.05)]


@query(f"""with {PAIR_COUNTS},
sk as (select u, (count(*) + 1.0) / (avg(num) + 1) as x from pairs group by u),
su as (select u, (x - (select min(x) from sk) + 1) / ((select max(x) from sk) - (select min(x) from sk) + 1) as su from sk),
tr as (select u, i, rating as r, su from kept join su using (u) where not {_TEST_PART}),
te as (select u, i, rating as r, su from kept left join su using (u) where {_TEST_PART}),
{_grid_sql(FORM_GRID)}""")
def factor_skill_forms(spark, sf):
    """Held-out error of every form after one and three epochs, all in one stacked fit."""
    _, train, test = _two_parts(spark, sf)
    skill = materialize(A.user_skill(A.interaction_counts(log_rows(spark, sf), "user", "item"), "user", "num", "smoothed"))
    return _rounded(sweep(train, test, FORM_GRID, skill=skill, start=arithmetic_start))


@query(f"""with {PAIR_COUNTS},
tr as (select u, i, rating as r, 0.0 as su from kept where not {_TEST_PART}),
te as (select u, i, rating as r, 0.0 as su from kept where {_TEST_PART}),
{_grid_sql(GRID)}""")
def factor_sweep(spark, sf):
    """Held-out error over ranks, steps and penalties, all in one stacked fit."""
    _, train, test = _two_parts(spark, sf)
    return _rounded(sweep(train, test, GRID, start=arithmetic_start))


_WALK = _walk_sql("w", 16, 10, 0.002)[0]


@query(f"""with {PAIR_COUNTS},
tr as (select u, i, rating as r, 0.0 as su from kept),
{', '.join(_WALK[:-1])}, {_WALK[-1]}
select 'u' as kind, u as id, {', '.join(f'round(p{n}, 6) as f{n - 1}' for n in range(1, 17))} from wp10
union all select 'i', i, {', '.join(f'round(q{n}, 6)' for n in range(1, 17))} from wq10""")
def factor_cells(spark, sf):
    """Sixteen factors after ten epochs over ratings that stay in their cells."""
    ratings = build_ratings([log_rows(spark, sf)], "user", "item", encode=False)
    model = FB.factorize_blocks(ratings, k=16, steps=10, start=arithmetic_start)
    return model.table.select("kind", F.col("id").cast("long").alias("id"), *[F.round(f"f{j}", 6).alias(f"f{j}") for j in range(16)])


_CELL_FORMS = [f for f in M.FORMS if f != "plain"]


@query(f"""with {PAIR_COUNTS},
sk as (select u, (count(*) + 1.0) / (avg(num) + 1) as x from pairs group by u),
su as (select u, (x - (select min(x) from sk) + 1) / ((select max(x) from sk) - (select min(x) from sk) + 1) as su from sk),
tr as (select u, i, rating as r, su from kept join su using (u)),
{', '.join(', '.join(_walk_sql(f"c{n}", 5, 5, 0.002, form=f, clip=1.0)[0]) for n, f in enumerate(_CELL_FORMS))}
{' union all '.join(f"select '{f}' as form, 'u' as kind, u as id, {', '.join(f'round(p{j}, 6) as f{j - 1}' for j in range(1, 6))}, 0.0 as bias from c{n}p5 "
  f"union all select '{f}', 'i', i, {', '.join(f'round(q{j}, 6)' for j in range(1, 6))}, round(si, 6) from c{n}q5" for n, f in enumerate(_CELL_FORMS))}""")
def factor_cells_forms(spark, sf):
    """Five factors and the item bias of every skill-aware form after five epochs in cells."""
    ratings = materialize(build_ratings([log_rows(spark, sf)], "user", "item", encode=False))
    skill = materialize(A.user_skill(A.interaction_counts(log_rows(spark, sf), "user", "item"), "user", "num", "smoothed"))
    parts = []
    with FB.dealt_ratings(ratings, skill) as dealt:
        for form in _CELL_FORMS:
            model = FB.factorize_blocks(ratings, k=5, steps=5, form=form, skill=skill, start=arithmetic_start, clip=1.0, dealt=dealt)
            parts.append(
                model.table.select(
                    F.lit(form).alias("form"), "kind", F.col("id").cast("long").alias("id"),
                    *[F.round(c, 6).alias(c) for c in ("f0", "f1", "f2", "f3", "f4", "bias")],
                )
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


def part_ratings(spark, sf):
    """Ratings of customers for all parts, from how often they bought them."""
    return build_ratings([log_rows(spark, sf)], "user", "item", encode=False).select("user", "item", "rating")


def _power_sql(rounds: int) -> str:
    """The first singular vector by plain power steps from equal weights; its values lie far apart, so few suffice."""
    parts = ["v0 as (select i, 1.0 as x from kept group by i)"]
    for n in range(rounds):
        parts += [
            f"y{n} as (select u, sum(rating * x) as y from kept join v{n} using (i) group by u)",
            f"z{n} as (select i, sum(rating * y) as z from kept join y{n} using (u) group by i)",
            f"v{n + 1} as (select i, z / (select sqrt(sum(z * z)) from z{n}) as x from z{n})",
        ]
    return f"with {PAIR_COUNTS},\n" + ",\n".join(parts)


@query(f"{_power_sql(16)}\nselect i as item, round(x, 4) as weight from v16")
def svd_item_factors(spark, sf):
    """The first item vector over all parts."""
    vectors = item_factors(part_ratings(spark, sf), share=1.0, max_rank=1, block=4)
    return vectors.select("item", F.round(F.col("v")[0], 4).alias("weight"))


@query(f"""{_power_sql(16)},
y as (select u, sum(rating * x) as y from kept join v16 using (i) group by u)
select (select count(distinct i) from kept) as items, round((select sum(rating * rating) from kept), 4) as energy,
round((select sum(y * y) from y), 4) as held, round((select sum(rating * rating) from kept) - (select sum(y * y) from y), 4) as squared_error""")
def svd_energy(spark, sf):
    """What the first item vector holds of the sum of squared ratings, and the squared error of the reconstruction."""
    ratings = materialize(part_ratings(spark, sf))
    vectors = item_factors(ratings, share=1.0, max_rank=1, block=4)
    whole, held = kept_energy(ratings, vectors)
    row = (vectors.count(), round(whole, 4), round(held, 4), round(whole - held, 4))
    return spark.createDataFrame([row], "items long, energy double, held double, squared_error double")


@query()
def svd_recommend(spark, sf):
    """Three parts for every customer, by the eight strongest item vectors."""
    ratings = materialize(part_ratings(spark, sf))
    return recommend(ratings, n=3, factors=item_factors(ratings, share=1.0, max_rank=8, passes=3))


def given_vectors(spark, sf):
    """Vectors made from the part's number, so that SQL has the same ones."""
    i = F.col("p_partkey")
    v = F.array((i * 7) % 10 + 1, (i * 3) % 7 - 3, (i * 5) % 11 - 5).cast("array<double>")
    return table(spark, sf, "part").select(i.alias("item"), v.alias("v"))


GIVEN = """raw as (select p_partkey as i, (p_partkey * 7) % 10 + 1.0 as x, (p_partkey * 3) % 7 - 3.0 as y, (p_partkey * 5) % 11 - 5.0 as z from part),
unit as (select i, cast(x as double) / sqrt(x * x + y * y + z * z) as x, cast(y as double) / sqrt(x * x + y * y + z * z) as y, cast(z as double) / sqrt(x * x + y * y + z * z) as z from raw),
prof as (select u, sum(cast(rating as double)) as s, count(*) as n, sum(rating * x) as ax, sum(rating * y) as ay, sum(rating * z) as az,
         sum(x) as bx, sum(y) as by_, sum(z) as bz from kept join unit using (i) group by u)"""


@query(f"""with {PAIR_COUNTS}, {GIVEN},
scored as (select u, i, round((s + ax * x + ay * y + az * z) / (n + bx * x + by_ * y + bz * z), 9) as e from prof, unit
           where n + bx * x + by_ * y + bz * z > 1e-9),
open_ as (select * from scored anti join kept using (u, i)),
best as (select *, row_number() over (partition by u order by e desc, i) as rank from open_ qualify rank <= 3)
select u as "user", i as item, round(e, 6) as estimate, rank from best""")
def recommend_given_vectors(spark, sf):
    """Three unrated parts for every customer out of all parts, by given item vectors."""
    out = recommend(part_ratings(spark, sf), n=3, factors=given_vectors(spark, sf))
    return out.select("user", "item", F.round("estimate", 6).alias("estimate"), "rank")


@query(f"""with {PAIR_COUNTS}, {GIVEN},
asked as (select c_custkey as u, (c_custkey * 37) % (2 * (select count(*) from part)) + 1 as i from customer),
near as (select a.u, a.i, sum(rating * w) / sum(w) as e from (
  select a.u, a.i, k.rating, 1 / (1 + sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2 + (p.z - q.z) ** 2)) as w
  from asked a join kept k on k.u = a.u and k.i <> a.i join raw p on p.i = a.i join raw q on q.i = k.i) a group by 1, 2)
select a.u as "user", a.i as item, round((s + ax * x + ay * y + az * z) / (n + bx * x + by_ * y + bz * z), 6) as estimate, round(near.e, 6) as by_distance
from asked a left join prof using (u) left join unit using (i) left join near on near.u = a.u and near.i = a.i""")
def estimate_pairs(spark, sf):
    """Estimates for given pairs, also unknown ones: by cosine, and by a similarity that falls with distance."""
    parts = table(spark, sf, "part").count()
    c = F.col("c_custkey")
    asked = table(spark, sf, "customer").select(c.alias("user"), ((c * 37) % (2 * parts) + 1).alias("item"))
    ratings, vectors = materialize(part_ratings(spark, sf)), given_vectors(spark, sf)
    near = estimate_by(asked, ratings, vectors, lambda x, y: 1 / (1 + np.sqrt(((x - y) ** 2).sum(axis=1))))
    cosine = estimate_unrated(asked, ratings, vectors)
    both = cosine.join(near.withColumnRenamed("estimate", "by_distance"), ["user", "item"])
    return both.select("user", "item", F.round("estimate", 6).alias("estimate"), F.round("by_distance", 6).alias("by_distance"))


def scaled_customers(spark, sf):
    """Two z-scores and a label of -1 or +1 per customer."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.avg("o_totalprice").alias("a"), F.count(F.lit(1)).alias("b"))
    rows = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey")).select(
        "a", F.col("b").cast("double").alias("b"), F.when(F.col("c_acctbal") < 4000, -1).otherwise(1).alias("y")
    )
    return A.standardize(rows, ["a", "b"]).select(F.col("a_std").alias("x1"), F.col("b_std").alias("x2"), "y")


@query("""with s as (select o_custkey, avg(o_totalprice) as a, count(*) as b from orders group by 1),
j as (select s.*, case when c_acctbal < 4000 then -1 else 1 end as y from s join customer on o_custkey = c_custkey),
z as (select (a - (select avg(a) from j)) / (select stddev_pop(a) from j) as x1, (b - (select avg(b) from j)) / (select stddev_pop(b) from j) as x2, y from j),
e1 as (select 0.0001 * sum(y) as w0, 0.0001 * sum(y * x1) as w1, 0.0001 * sum(y * x2) as w2, sum(y * y) / 2.0 as cost from z),
r as (select x1, x2, y - (w0 + w1 * x1 + w2 * x2) as e, w0, w1, w2 from z, e1),
e2 as (select any_value(w0) + 0.0001 * sum(e) as w0, any_value(w1) + 0.0001 * sum(e * x1) as w1, any_value(w2) + 0.0001 * sum(e * x2) as w2, sum(e * e) / 2 as cost from r)
select 1 as epoch, round(w0, 6) as w0, round(w1, 6) as w1, round(w2, 6) as w2, round(cost, 4) as cost, round(log10(cost), 6) as log_cost from e1
union all select 2, round(w0, 6), round(w1, 6), round(w2, 6), round(cost, 4), round(log10(cost), 6) from e2""")
def adaline_epochs(spark, sf):
    data = scaled_customers(spark, sf).persist()
    rows = []
    for n in (1, 2):
        model = L.fit_linear(data, ["x1", "x2"], "y", epochs=n, eta=0.0001)
        rows.append((n, *[float(w) for w in model.weights], model.history[-1]))
    data.unpersist()
    out = spark.createDataFrame(rows, "epoch int, w0 double, w1 double, w2 double, cost double")
    return out.select(
        "epoch", *[F.round(c, 6).alias(c) for c in ("w0", "w1", "w2")], F.round("cost", 4).alias("cost"),
        F.round(F.log10("cost"), 6).alias("log_cost"),
    )


_PASS = """list_reduce(rows_, lambda a, r: {'x1': r.x1, 'x2': r.x2, 'y': r.y,
  'w0': a.w0 + 0.001 * (r.y - (a.w0 + a.w1 * r.x1 + a.w2 * r.x2)), 'w1': a.w1 + 0.001 * (r.y - (a.w0 + a.w1 * r.x1 + a.w2 * r.x2)) * r.x1,
  'w2': a.w2 + 0.001 * (r.y - (a.w0 + a.w1 * r.x1 + a.w2 * r.x2)) * r.x2,
  'c': a.c + (r.y - (a.w0 + a.w1 * r.x1 + a.w2 * r.x2)) * (r.y - (a.w0 + a.w1 * r.x1 + a.w2 * r.x2)) / 2}, %s)"""


@query(f"""with z as (select l_orderkey, l_linenumber, l_quantity::double / 50 as x1, l_discount::double * 10 as x2, case when l_returnflag = 'R' then 1.0::double else -1.0::double end as y from lineitem),
l as (select list({{'x1': x1, 'x2': x2, 'y': y, 'w0': 0.0::double, 'w1': 0.0::double, 'w2': 0.0::double, 'c': 0.0::double}} order by l_orderkey, l_linenumber, x1, x2, y) as rows_ from z),
s1 as (select rows_, {_PASS % "{'x1': 0.0::double, 'x2': 0.0::double, 'y': 0.0::double, 'w0': 0.0::double, 'w1': 0.0::double, 'w2': 0.0::double, 'c': 0.0::double}"} as s from l),
s2 as (select rows_, {_PASS % "{'x1': 0.0::double, 'x2': 0.0::double, 'y': 0.0::double, 'w0': s.w0, 'w1': s.w1, 'w2': s.w2, 'c': 0.0::double}"} as s from s1)
select epoch, round(s.w0, 6) as w0, round(s.w1, 6) as w1, round(s.w2, 6) as w2, round(s.c / len(rows_), 6) as mean_cost
from (select 1 as epoch, * from s1 union all select 2, * from s2)""")
def adaline_rows(spark, sf):
    """Weights after each of two passes over all lines, one update a line in the order of the orders."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity").cast("double") / 50).alias("x1"), (F.col("l_discount").cast("double") * 10).alias("x2"),
        F.when(F.col("l_returnflag") == "R", 1.0).otherwise(-1.0).alias("y"),
    )
    out, weights = [], None
    for epoch in (1, 2):
        model = L.fit_linear(rows, ["x1", "x2"], "y", mode="ordered", order=["l_orderkey", "l_linenumber"], eta=0.001, epochs=1, start=weights)
        weights = model.weights
        out.append((epoch, *[float(w) for w in weights], model.history[-1]))
    frame = spark.createDataFrame(out, "epoch int, w0 double, w1 double, w2 double, mean_cost double")
    return frame.select("epoch", *[F.round(c, 6).alias(c) for c in ("w0", "w1", "w2", "mean_cost")])


RULES = {
    "sgd": L.sgd(1e-4), "momentum": L.momentum(1e-4), "nesterov": L.nesterov(1e-4),
    "adagrad": L.adagrad(0.05), "rmsprop": L.rmsprop(0.01), "adam": L.adam(0.05),
}


# Each rule in SQL: the state after the first gradient g, the weight then, and both after the second one; all start at zero.
_RULE_STEPS = {
    "sgd": ("0.0", "-0.0001 * g", "0.0", "w - 0.0001 * g"),
    "momentum": ("-0.0001 * g", "-0.0001 * g", "0.9 * s - 0.0001 * g", "w + 0.9 * s - 0.0001 * g"),
    "nesterov": ("-0.0001 * g", "-1.9 * 0.0001 * g", "0.9 * s - 0.0001 * g", "w + 0.81 * s - 1.9 * 0.0001 * g"),
    "adagrad": ("g * g", "-0.05 * g / (abs(g) + 1e-7)", "s + g * g", "w - 0.05 * g / (sqrt(s + g * g) + 1e-7)"),
    "rmsprop": (
        "0.01 * g * g", "-0.01 * g / (sqrt(0.01 * g * g) + 1e-7)",
        "0.99 * s + 0.01 * g * g", "w - 0.01 * g / (sqrt(0.99 * s + 0.01 * g * g) + 1e-7)",
    ),
    "adam": (
        "0.001 * g * g", "-0.05 * sqrt(0.001) / 0.1 * 0.1 * g / (sqrt(0.001 * g * g) + 1e-7)",
        "0.999 * s + 0.001 * g * g",
        "w - 0.05 * sqrt(1 - 0.999 * 0.999) / (1 - 0.9 * 0.9) * (0.9 * 0.1 * g1 + 0.1 * g) / (sqrt(0.999 * s + 0.001 * g * g) + 1e-7)",
    ),
}
_FIRST = " union all ".join(f"select '{r}' as rule, i, g, {s} as s, {w} as w from g1" for r, (s, w, _, _) in _RULE_STEPS.items())
_SECOND = " ".join(f"when '{r}' then {w}" for r, (_, _, _, w) in _RULE_STEPS.items())


@query(f"""with f as (select o_custkey, avg(o_totalprice) as a, count(*) as b from orders group by 1),
j as (select f.*, case when c_acctbal < 4000 then -1 else 1 end as y from f join customer on o_custkey = c_custkey),
z as (select (a - (select avg(a) from j)) / (select stddev_pop(a) from j) as x1, (b - (select avg(b) from j)) / (select stddev_pop(b) from j) as x2, y from j),
g1 as (select 0 as i, -sum(y)::double as g from z union all select 1, -sum(y * x1) from z union all select 2, -sum(y * x2) from z),
t1 as ({_FIRST}),
v1 as (select rule, sum(w) filter (i = 0) as w0, sum(w) filter (i = 1) as w1, sum(w) filter (i = 2) as w2 from t1 group by rule),
e as (select rule, x1, x2, y - (w0 + w1 * x1 + w2 * x2) as e from z, v1),
g2 as (select rule, 0 as i, -sum(e) as g from e group by rule union all select rule, 1, -sum(e * x1) from e group by rule union all select rule, 2, -sum(e * x2) from e group by rule),
t2 as (select rule, i, case rule {_SECOND} end as w from (select t1.rule, t1.i, t1.g as g1, t1.s, t1.w, g2.g from t1 join g2 using (rule, i))),
all_ as (select rule, 1 as epochs, i, w, (select sum(y * y) / 2.0 from z) as cost from t1
  union all select rule, 2, i, w, (select sum(e * e) / 2 from e where e.rule = t2.rule) from t2)
select rule, epochs, round(sum(w) filter (i = 0), 6) as w0, round(sum(w) filter (i = 1), 6) as w1, round(sum(w) filter (i = 2), 6) as w2,
round(any_value(cost), 3) as cost from all_ group by rule, epochs""")
def rule_epochs(spark, sf):
    """Weights and half squared error of every update rule after one and two epochs over all customers."""
    data = scaled_customers(spark, sf).persist()
    rows = []
    for name, rule in RULES.items():
        for n in (1, 2):
            model = L.fit_linear(data, ["x1", "x2"], "y", rule=rule, epochs=n)
            rows.append((name, n, *[float(w) for w in model.weights], model.history[-1]))
    data.unpersist()
    out = spark.createDataFrame(rows, "rule string, epochs int, w0 double, w1 double, w2 double, cost double")
    return out.select("rule", "epochs", *[F.round(c, 6).alias(c) for c in ("w0", "w1", "w2")], F.round("cost", 3).alias("cost"))


@query()
def linear_rules(spark, sf):
    """Accuracy of each update rule and of the row-by-row fits on the vectors, over 20 epochs (40 for the classes)."""
    names = [f"x{j}" for j in range(64)]
    wide = L.spread_array(table(spark, sf, "embeddings"), "embedding", 64)
    data = wide.select("vec_id", *names, "label", F.when(F.col("label") < 5, -1).otherwise(1).alias("y")).persist()
    rows = []

    def add(name, model, label):
        hit = A.accuracy(data.withColumn("_p", model.predict()), label, "_p").first()[0]
        rows.append((name, len(model.history), float(model.history[-1]), hit))

    for name, rule in RULES.items():
        add(name, L.fit_linear(data, names, "y", rule=rule, epochs=20), "y")
    add("adaline_mixing", L.fit_linear(data, names, "y", mode="mixing", epochs=20), "y")
    add("adaline_ordered", L.fit_linear(data, names, "y", mode="ordered", order=["vec_id"], epochs=20), "y")
    add("perceptron_mixing", L.fit_linear(data, names, "y", kind="perceptron", mode="mixing", epochs=20), "y")
    add("one_vs_rest", L.fit_one_vs_rest(data, names, "label", epochs=40), "label")
    data.unpersist()
    return spark.createDataFrame(rows, "rule string, epochs int, metric double, accuracy double")


def _stream_step(part: int) -> str:
    """Weights after one more third of the events, from those before."""
    e = f"(select r.*, w.w0, w.w1, w.w2, y - (w.w0 + w.w1 * x1 + w.w2 * x2) as e from r cross join s{part} w where part = {part})"
    weights = ", ".join(f"any_value(w{j}) + 0.05 * sum(e{x}) / count(*) as w{j}" for j, x in enumerate(("", " * x1", " * x2")))
    return f"s{part + 1} as (select {part} as batch, {weights}, count(*) as rows, sum(e * e) / 2 / count(*) as mean_cost from {e})"


@query(f"""with r as (select value / 100 as x1, hour(ts) / 24 as x2, case when event_type = 'purchase' then 1 else -1 end as y, event_id % 3 as part from events),
s0 as (select 0.0::double as w0, 0.0::double as w1, 0.0::double as w2), {', '.join(map(_stream_step, range(3)))}
select batch, round(w0, 6) as w0, round(w1, 6) as w1, round(w2, 6) as w2, rows, round(mean_cost, 6) as mean_cost
from (select * from s1 union all select * from s2 union all select * from s3)""")
def partial_fit_steps(spark, sf):
    """The events arrive in three parts; weights after each, carried on through the stream's checkpoint."""
    folder = f"{shared_folder(spark)}/riffle-stream/{uuid.uuid4().hex}"
    whole = table(spark, sf, "events")
    for part in range(3):
        whole.filter(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{folder}/source")
        _fit_arrived(spark.readStream.schema(whole.schema).parquet(f"{folder}/source"), folder)
    weights = [F.round(F.col("weights")[j], 6).alias(f"w{j}") for j in range(3)]
    mean_cost = F.round(F.col("cost") / F.col("rows"), 6).alias("mean_cost")
    return weights_by_batch(spark, folder).select("batch", *weights, "rows", mean_cost)


def _fit_arrived(events, folder):
    rows = events.select(
        (F.col("value") / 100).alias("x1"), (F.hour("ts") / 24).alias("x2"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(-1).alias("y"),
    )
    partial_fit_stream(rows, ["x1", "x2"], "y", folder, eta=0.05).awaitTermination()


@query("""with r as (select case when label < 5 then 1 else 0 end as y, round(embedding[1], 2) as s from embeddings),
c as (select s, sum(y) as pos, sum(1 - y) as neg from r group by s),
w as (select *, sum(neg) over (order by s) - neg / 2.0 as below from c)
select round(sum(pos * below) / (sum(pos) * sum(neg)), 6) as auc, (select round(avg(case when y = (case when s > 0 then 1 else 0 end) then 1.0 else 0.0 end), 6) from r) as accuracy,
(select round(sqrt(avg((y - s) * (y - s))), 6) from r) as rmse from w""")
def ranking_metrics(spark, sf):
    data = table(spark, sf, "embeddings").select(
        F.when(F.col("label") < 5, 1).otherwise(0).alias("y"), F.round(F.col("embedding")[0].cast("double"), 2).alias("s")
    ).withColumn("p", F.when(F.col("s") > 0, 1).otherwise(0))
    out = A.auc(data, "y", "s").select(F.round("auc", 6).alias("auc"))
    return out.withColumn("accuracy", F.round(A.accuracy(data, "y", "p").scalar(), 6)).withColumn(
        "rmse", F.round(A.rmse(data, "y", "s").scalar(), 6)
    )


TRAIN_LINES = """f as (select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_returnflag = 'R' then 1 else 0 end as y,
  md5(concat_ws('|', 1, l_orderkey, l_linenumber, l_partkey, l_suppkey)) as mark from lineitem where l_linestatus = 'F'),
p as (select avg(y) as prior from f)"""


LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def flagged_lines(spark, sf):
    """Finished and open lines with whether they were returned."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y")
    )
    return tuple(part.drop("l_linestatus") for part in S.split(lines))


def _code_sql(c: str) -> str:
    before = f"over (partition by {c} order by mark rows between unbounded preceding and 1 preceding)"
    return f"round((coalesce(sum(y) {before}, 0) + prior) / (count(*) {before} + 1), 9) as {c}_code"


@query(f"with {TRAIN_LINES} select l_orderkey, l_linenumber, {_code_sql('l_partkey')}, {_code_sql('l_suppkey')} from f, p")
def ordered_codes(spark, sf):
    """Target statistics of parts and suppliers that no row's own label is in."""
    train, _ = flagged_lines(spark, sf)
    out, _ = B.ordered_target_codes(train, ["l_partkey", "l_suppkey"], "y", LINE_KEY)
    return out.select("l_orderkey", "l_linenumber", *[F.round(f"{c}_code", 9).alias(f"{c}_code") for c in ("l_partkey", "l_suppkey")])


@query(f"""with {TRAIN_LINES}, c as (select l_partkey, (sum(y) + any_value(prior)) / (count(*) + 1) as code from f, p group by 1)
select l_orderkey, l_linenumber, round(coalesce(code, prior), 9) as code from lineitem left join c using (l_partkey), p where l_linestatus = 'O'""")
def later_codes(spark, sf):
    """The codes that open lines get from all finished ones."""
    train, test = flagged_lines(spark, sf)
    _, codes = B.ordered_target_codes(train, ["l_partkey"], "y", LINE_KEY)
    return B.coded(test, codes).select("l_orderkey", "l_linenumber", F.round("l_partkey_code", 9).alias("code"))


@query()
def gbt_scores(spark, sf):
    """Best score per open line from trees on the derived columns."""
    from riffle.plans.songs import song_features

    train, test = S.split(S.fact_rows(spark, sf))
    dims = (train, test, S.members(spark, sf), S.songs(spark, sf), S.codes(spark, sf))
    numeric = [
        "song_length", "bd", "membership_days", "song_year", "lyricists_count", "composer_count", "is_featured",
        "artist_count", "song_lang_boolean", "smaller_song", "count_song_played", "count_artist_played",
    ]
    labels = ["source_system_tab", "source_screen_name", "source_type", "gender", "language", "artist_tag", "genre_tag"]
    keep = [*S.ID, "target", *numeric, *labels]
    fit_rows = materialize(song_features(train, *dims).select(keep), B.ROWS_PER_TASK)
    model = B.fit_gbt(fit_rows, "target", numeric, labels, rounds=3, depth=4)
    scored = B.score(model, song_features(test, *dims).select(keep))
    return scored.groupBy(*S.ID).agg(F.max("score").alias("score"))
