"""Joins, counts, first and top rows, ordered sums, clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from riffle.functions import clean as C
from riffle.functions import text as X
from riffle.operators import aggregates as A
from riffle.operators import joins as J
from riffle.operators import ordering as O
from riffle.operators.sampling import FACTOR, PRIME, ROUNDS, group_sample, round_keys, shuffled, split_parts
from riffle.plans import boost
from riffle.plans import routes as R
from riffle.plans.ratings import build_ratings
from riffle.queries import standin as S
from riffle.queries.registry import query, table


def log_rows(spark, sf):
    """Three order logs in one, joined to their lines: columns user, item."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    f, o, p = (orders.filter(F.col("o_orderstatus") == s) for s in ("F", "O", "P"))
    logs = f.unionByName(o).unionByName(p)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return lines.join(logs, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")
    )


PAIR_COUNTS = """
pairs as (select o_custkey as u, l_partkey as i, count(*) as num
          from lineitem join orders on l_orderkey = o_orderkey
          where o_orderstatus in ('F', 'O', 'P') group by 1, 2),
kept as (select *, (num - (select min(num) from pairs where num < 60) + 1) * 1.0
           / ((select max(num) from pairs where num < 60) - (select min(num) from pairs where num < 60) + 1) as rating
         from pairs where num < 60)
"""


@query(f"""with {PAIR_COUNTS},
us as (select u, row_number() over (order by u) - 1 as code from (select distinct u from pairs)),
its as (select i, row_number() over (order by i) - 1 as code from (select distinct i from pairs))
select us.code as "user", its.code as item, num, round(rating, 6) as rating
from kept join us on kept.u = us.u join its on kept.i = its.i""")
def ratings_from_logs(spark, sf):
    out = build_ratings([log_rows(spark, sf)], "user", "item")
    return out.select("user", "item", "num", F.round("rating", 6).alias("rating"))


@query(f"""with {PAIR_COUNTS}
select "user", item, rating, rank from (
  select u as "user", i as item, round(rating, 6) as rating,
         row_number() over (partition by u order by rating desc, i) as rank from kept)
where rank <= 3""")
def top_items_per_customer(spark, sf):
    out = build_ratings([log_rows(spark, sf)], "user", "item", encode=False)
    top = A.top_n(out, ["user"], [F.col("rating").desc(), F.col("item")], 3, "rank")
    return top.select("user", "item", F.round("rating", 6).alias("rating"), "rank")


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, c_name, c_mktsegment, n_name, p_name, p_brand, s_name
from lineitem left join orders on l_orderkey = o_orderkey left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey left join part on l_partkey = p_partkey
left join supplier on l_suppkey = s_suppkey""")
def star_enrich(spark, sf):
    def dim(name, key, fact_key, *cols):
        return table(spark, sf, name).select(F.col(key).alias(fact_key), *cols), fact_key

    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = J.enrich(
        lines,
        [
            dim("orders", "o_orderkey", "l_orderkey", "o_custkey", "o_orderdate"),
            dim("customer", "c_custkey", "o_custkey", "c_name", "c_mktsegment", "c_nationkey"),
            dim("nation", "n_nationkey", "c_nationkey", "n_name"),
            dim("part", "p_partkey", "l_partkey", "p_name", "p_brand"),
            dim("supplier", "s_suppkey", "l_suppkey", "s_name"),
        ],
    )
    return out.drop("o_custkey", "c_nationkey")


@query("""select distinct o_orderkey, o_totalprice, n_name
from orders left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey and n_regionkey = 2""")
def left_join_residual(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    links = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    out = J.questions_with_knowledge(
        orders, links, table(spark, sf, "nation"), "o_custkey", "n_nationkey", F.col("n_regionkey") == 2
    )
    return out.select("o_orderkey", "o_totalprice", "n_name").distinct()


@query(f"""with {S.SQL},
t as (select row_number() over () as rid, msno, song_id from facts where l_linestatus = 'F'),
q as (select * from facts where l_linestatus = 'O'),
c as (select {', '.join('q.' + c for c in S.ID)}, rid from q join t on q.msno = t.msno
      union select {', '.join('q.' + c for c in S.ID)}, rid from q join t on q.song_id = t.song_id)
select {', '.join('q.' + c for c in S.ID)}, coalesce(n, 0) as candidates
from q left join (select {', '.join(S.ID)}, count(*) as n from c group by all) using ({', '.join(S.ID)})""")
def candidates_any_key(spark, sf):
    train, test = S.split(S.fact_rows(spark, sf))
    return J.candidate_counts(test.select(*S.ID, "msno", "song_id"), train, ("msno", "song_id")).select(*S.ID, "candidates")


@query("""select p_partkey, w as prefix from part a join
(select distinct p_brand as b, split_part(p_name, ' ', 1) as w from part) ids
on a.p_brand = ids.b and starts_with(a.p_name, w)""")
def prefix_match(spark, sf):
    part = table(spark, sf, "part")
    ids = part.select("p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("prefix"))
    return J.prefix_join(part.select("p_partkey", "p_brand", "p_name"), ids, "p_brand", "p_name", "prefix").select(
        "p_partkey", "prefix"
    )


@query("""select u.conv_id, u.turn, a.answer from conversations u join
(select conv_id, arg_max(text, turn) as answer from conversations where role = 'assistant' group by conv_id) a
using (conv_id) where u.role = 'user'""")
def pair_within(spark, sf):
    turns = table(spark, sf, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn")
    said = turns.filter("role = 'assistant'").select("conv_id", F.col("turn").alias("at"), F.col("text").alias("answer"))
    return J.pair_within(asked, said, "conv_id", "answer", "at")


@query(r"""with refs as (select distinct unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) as path from pages),
have as (select regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) as path from pages)
select path from refs where path not in (select path from have)""")
def missing_assets(spark, sf):
    pages = table(spark, sf, "pages")
    refs = pages.select(F.explode(X.html_links(F.col("html"))).alias("path"))
    have = pages.select(F.regexp_extract("url", r"^https?://[^/]+(/[^?#]*)", 1).alias("path"))
    return J.missing_assets(refs, have, "path")


@query("""with t as (select l_orderkey, count(*) n from lineitem where l_linestatus = 'F' group by 1),
s as (select l_orderkey, count(*) n from lineitem where l_linestatus = 'O' group by 1)
select o_orderkey, coalesce(t.n, s.n, 0) as played from orders left join t on o_orderkey = t.l_orderkey
left join s on o_orderkey = s.l_orderkey""")
def popularity_fallback(spark, sf):
    """Finished lines of every order; orders without any count their open ones."""
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus")
    train, test = lines.filter("l_linestatus = 'F'"), lines.filter("l_linestatus = 'O'")
    return J.popularity(table(spark, sf, "orders").select("o_orderkey"), train, test, "o_orderkey", "played")


@query("""with words as (select distinct w from (
    select unnest(string_split(p_name, ' ')) as w from part union all select c_mktsegment from customer))
select p_partkey, dense_rank() over (order by p_brand) - 1 as p_brand,
       (select count(*) from words where w <= split_part(p_name, ' ', 1)) as word_code
from part""")
def encode_vocab(spark, sf):
    part = table(spark, sf, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("w")).union(table(spark, sf, "customer").select("c_mktsegment"))
    labelled = O.label_encode(part.select("p_partkey", "p_brand", "p_name"), ["p_brand"])
    first = labelled.withColumn("w", F.split_part("p_name", F.lit(" "), F.lit(1)))
    return O.encode_ids(first, "w", O.vocabulary(words, "w"), "word_code").select("p_partkey", "p_brand", "word_code")


@query("select event_type, count(*) as n, count(distinct user_id) as users from events group by 1")
def event_frequency(spark, sf):
    events = table(spark, sf, "events")
    users = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    return A.value_counts(events, "event_type").join(users, "event_type")


@query("select tag, count(*) as n from (select unnest(string_split(p_name, ' ')) as tag from part) group by 1")
def tag_frequency(spark, sf):
    return A.tag_counts(table(spark, sf, "part"), "p_name", " ")


@query("""with w as (select count(*) as n from (select unnest(regexp_split_to_array(text, '\\s+')) as tag from documents)
           where tag <> '' group by tag),
q as (select quantile_cont(n, 0.25) as q1, quantile_cont(n, 0.5) as median, quantile_cont(n, 0.75) as q3 from w)
select count(*) as n, round(avg(w.n), 6) as mean, any_value(q1) as q1, any_value(median) as median, any_value(q3) as q3,
  min(case when w.n >= q1 - 1.5 * (q3 - q1) then w.n end) as whisker_low,
  max(case when w.n <= q3 + 1.5 * (q3 - q1) then w.n end) as whisker_high from w, q""")
def tag_summary(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", r"\s+")).alias("tag")).filter("tag <> ''")
    out = A.distribution_summary(A.value_counts(words, "tag"), "n")
    return out.withColumn("mean", F.round("mean", 6))


@query("select l_orderkey, max(l_extendedprice) as best from lineitem group by 1")
def best_per_id(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("best"))
    return boost.best_per_id(lines, "l_orderkey", "best")


@query(f"""with {PAIR_COUNTS},
a as (select u, count(*) as n, avg(rating) as m from kept group by u)
select u as "user", round(((n - (select min(n) from a) + 1.0) / ((select max(n) from a) - (select min(n) from a) + 1)) / m, 8) as su from a""")
def user_skill(spark, sf):
    counts = A.interaction_counts(log_rows(spark, sf), "user", "item")
    return A.user_skill(counts, "user", "num").withColumn("su", F.round("su", 8))


@query(f"""with {PAIR_COUNTS},
a as (select u, (count(*) + 1.0) / (avg(num) + 1) as x from pairs group by u)
select u as "user", round((x - (select min(x) from a) + 1) / ((select max(x) from a) - (select min(x) from a) + 1), 6) as su from a""")
def user_skill_smoothed(spark, sf):
    counts = A.interaction_counts(log_rows(spark, sf), "user", "item")
    return A.user_skill(counts, "user", "num", "smoothed").withColumn("su", F.round("su", 6))


@query("""select o_orderkey, round((o_totalprice - (select avg(o_totalprice) from orders)) / (select stddev_pop(o_totalprice) from orders), 6) as price_std,
round((o_custkey - (select avg(o_custkey) from orders)) / (select stddev_pop(o_custkey) from orders), 6) as cust_std from orders""")
def standardize(spark, sf):
    out = A.standardize(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey"), ["o_totalprice", "o_custkey"])
    return out.select("o_orderkey", F.round("o_totalprice_std", 6).alias("price_std"), F.round("o_custkey_std", 6).alias("cust_std"))


@query("""select vec_id, d, round((x - avg(x) over (partition by d)) / stddev_pop(x) over (partition by d), 4) as z from (
  select vec_id, d, cast(embedding[d] as double) as x from embeddings, (select unnest([1, 2]) as d))""")
def standardize_vectors(spark, sf):
    wide = table(spark, sf, "embeddings").select("vec_id", *[F.col("embedding")[j].cast("double").alias(f"x{j + 1}") for j in range(2)])
    out = A.standardize(wide, ["x1", "x2"])
    pairs = F.array(*[F.struct(F.lit(j).alias("d"), F.round(f"x{j}_std", 4).alias("z")) for j in (1, 2)])
    return out.select("vec_id", F.explode(pairs).alias("s")).select("vec_id", "s.d", "s.z")


@query("""select doc_id, replace(text, chr(10), '') as lines,
case when len(m) > 0 then concat(',', array_to_string(m, ',')) else '' end as mails from (
  select doc_id, text, regexp_extract_all(text, '([A-Za-z0-9._]+@[A-Za-z0-9.]+)', 1) as m from documents)""")
def flatten_lines(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", F.split("text", "\n").alias("lines"),
        F.regexp_extract_all("text", F.lit("([A-Za-z0-9._]+@[A-Za-z0-9.]+)"), F.lit(1)).alias("mails"),
    )
    return A.flatten_lists(docs, "lines", "mails")


@query("select conv_id, arg_max(role, turn) as role, arg_max(text, turn) as text from conversations group by 1")
def last_turn(spark, sf):
    return A.last_by(table(spark, sf, "conversations"), "conv_id", "turn", ["role", "text"])


@query("""select doc_id, text, lang from (
select *, row_number() over (partition by md5(text) order by doc_id) as r from documents) where r = 1""")
def dedup_first(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang").withColumn("h", F.md5("text"))
    return A.dedup_first(docs, ["h"], ["doc_id"]).drop("h")


@query("""select user_id, event_type, event_id, value from (
select *, row_number() over (partition by user_id, event_type order by ts, event_id) as r from events) where r = 1""")
def dedup_first_event(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return A.dedup_first(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("""select o_orderkey, round(sum(o_totalprice) over w, 2) as cum_sum,
round(100 * sum(o_totalprice) over w / (select sum(o_totalprice) from orders), 6) as cum_pct
from orders window w as (order by o_totalprice desc, o_orderkey rows unbounded preceding)""")
def cumulative_share(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    out = O.cumulative_share(rows, "o_totalprice", [F.col("o_totalprice").desc(), "o_orderkey"])
    return out.select("o_orderkey", F.round("cum_sum", 2).alias("cum_sum"), F.round("cum_pct", 6).alias("cum_pct"))


@query("""with c as (select p_partkey, sum(p_retailprice) over (order by p_retailprice desc, p_partkey rows unbounded preceding) as hi from part),
s as (select p_partkey, hi / (select max(hi) from c) as hi, lag(hi, 1, 0.0) over (order by hi) / (select max(hi) from c) as lo from c),
p as (select c_custkey, ((c_custkey * 7919) % 10007) / 10007.0 as pick from customer)
select c_custkey, p_partkey from p join s on pick >= lo and pick < hi""")
def roulette_sample(spark, sf):
    picks = table(spark, sf, "customer").select("c_custkey", ((F.col("c_custkey") * 7919) % 10007 / 10007.0).alias("pick"))
    parts = table(spark, sf, "part").select("p_partkey", "p_retailprice")
    out = R.roulette_sample(parts, "p_retailprice", [F.col("p_retailprice").desc(), "p_partkey"], picks)
    return out.select("c_custkey", "p_partkey")


@query("""with c as (select o_orderkey, o_custkey, sum(o_totalprice) over (order by o_totalprice desc, o_orderkey rows unbounded preceding) as hi from orders),
s as (select o_orderkey, o_custkey, lag(hi, 1, 0.0) over (order by hi) / (select max(hi) from c) as lo from c),
p as (select l_orderkey, l_linenumber, l_partkey, ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1000003) / 1000003.0 as pick from lineitem)
select p.l_orderkey, p.l_linenumber, p.l_partkey, s.o_orderkey as drawn, s.o_custkey as customer from p asof join s on p.pick >= s.lo""")
def roulette_many_picks(spark, sf):
    """One weighted draw of an order for every line: more picks than rows to draw from."""
    lines = table(spark, sf, "lineitem")
    number = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % 1000003
    picks = lines.select("l_orderkey", "l_linenumber", "l_partkey", (number / 1000003.0).alias("pick"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    out = R.roulette_sample(orders, "o_totalprice", [F.col("o_totalprice").desc(), "o_orderkey"], picks)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("o_orderkey").alias("drawn"), F.col("o_custkey").alias("customer"))


@query("""select user_id, event_id, value, rank from (select user_id, event_id, value,
row_number() over (partition by user_id order by value desc, event_id) as rank from events) where rank <= 5""")
def top_n_per_user(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "value")
    return A.top_n(events, ["user_id"], [F.col("value").desc(), F.col("event_id")], 5, "rank")


def order_tours(spark, sf):
    """Each order as a round trip past the nations of its suppliers."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    nations = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("stop"))
    routes = O.positions(J.lookup_join(lines, nations, "l_suppkey"), "l_orderkey", ["l_linenumber", "l_suppkey"])
    edges = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(11))).alias("k")
    ).select("a", ((F.col("a") + F.col("k")) % 25).alias("b"), (F.lit(1.0) + F.col("a") * F.col("k") % 7).alias("d"))
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "d"))
    return R.tour_length(routes.select(F.col("l_orderkey").alias("route"), "pos", "stop"), both)


TOURS = """
r as (select l_orderkey as route, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey) as pos,
        s_nationkey as stop from lineitem join supplier on l_suppkey = s_suppkey),
e as (select n_nationkey as a, (n_nationkey + k) % 25 as b, 1.0 + n_nationkey * k % 7 as d
      from nation, (select unnest(range(0, 12)) as k)),
g as (select a, b, min(d) as d from (select a, b, d from e union all select b, a, d from e) group by a, b),
n as (select route, stop as a, coalesce(lead(stop) over (partition by route order by pos),
        first_value(stop) over (partition by route order by pos)) as b from r),
tours as (select route, sum(case when d is null then 'infinity'::double else d::double end) as length
          from n left join g using (a, b) group by route)
"""


@query(f"""with {TOURS} select route, case when isinf(length) then -1.0 else length end as length,
round(1 / length, 6) as fitness from tours""")
def tour_length(spark, sf):
    out = R.fitness(order_tours(spark, sf))
    finite = F.when(F.col("length") == float("inf"), -1.0).otherwise(F.col("length"))
    return out.select("route", finite.alias("length"), F.round("fitness", 6).alias("fitness"))


@query(f"""with {TOURS} select route, row_number() over (order by 1 / length desc, route) as rank from tours""")
def rank_routes(spark, sf):
    return R.rank_routes(R.fitness(order_tours(spark, sf))).select("route", "rank")


@query(f"""with {TOURS} select route, round(1 / length, 6) as fitness from tours order by 1 / length desc, route limit 20""")
def elite_routes(spark, sf):
    out = R.elite(R.fitness(order_tours(spark, sf)), 20)
    return out.select("route", F.round("fitness", 6).alias("fitness"))


@query("""select doc_id, quality, line from (
select d.doc_id, quality, unnest(string_split(d.text, chr(10))) as line from documents d left join labels l on d.doc_id = l.doc_id)
where quality is not null and line is not null and line <> ''""")
def drop_blank(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    lines = docs.select("doc_id", "quality", F.explode(F.split("text", "\n")).alias("line"))
    return C.drop_blank(lines, ["quality", "line"])


@query("""select d.doc_id, lang, coalesce(quality, -1) as quality, coalesce(cast(toxic as varchar), 'no') as toxic
from documents d left join labels l on d.doc_id = l.doc_id""")
def fill_missing(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return C.fill_missing(C.cast_by_type(docs, "int", "string"), {"quality": "-1", "toxic": "no"}).withColumn(
        "quality", F.col("quality").cast("int")
    )


def _places_sql(table_: str, key: str, seed: int) -> str:
    """Places of ``table_``'s rows by ``riffle.operators.sampling``, one round after the other."""
    keys = ", ".join(map(str, round_keys(seed)))
    return f"""with recursive keys as (select unnest([{keys}]) as k, unnest(range(1, {ROUNDS} + 1)) as step),
n as (select count(*) as n from {table_}),
turns as (
  select {key} as id, row_number() over (order by {key}) - 1 as x, 0 as step from {table_}
  union all
  select id, case when y * y % {PRIME} * 2 < {PRIME} then other else x end, step
  from (select *, (greatest(x, other) % {PRIME} + k) % {PRIME} * {FACTOR} % {PRIME} as y from
  (select id, x, k, keys.step as step, ((k - x) % n + n) % n as other from turns join keys on keys.step = turns.step + 1, n))),
places as (select id, x as place from turns where step = {ROUNDS})"""


@query(f"""{_places_sql('orders', 'o_orderkey', 5)} select id as o_orderkey, place from places""")
def shuffled_orders(spark, sf):
    return shuffled(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 5)


@query(f"""{_places_sql('labels', 'doc_id', 11)}, m as (select count(*) as m from labels)
select doc_id, quality, toxic, place, case when place < cast(floor(m * 0.8 + 0.5) as bigint) then 0
  when place < cast(floor(m * 0.9 + 0.5) as bigint) then 1 else -1 end as part from labels join places on id = doc_id, m""")
def train_test_parts(spark, sf):
    """Part and place of every labelled row: 80 and 10 percent, the rest outside."""
    return split_parts(table(spark, sf, "labels"), ["doc_id"], [0.8, 0.1], 11)


@query("""select source, doc_id, n_chars from (select *, row_number() over (partition by source order by md5('3:' || doc_id), doc_id) as r from documents) where r <= 25""")
def source_samples(spark, sf):
    """Twenty-five documents of each source."""
    return group_sample(table(spark, sf, "documents").select("source", "doc_id", "n_chars"), ["source"], "doc_id", 25, 3)


@query("select doc_id, quality, toxic, count(*) over () as n from labels")
def split_union(spark, sf):
    """Both parts of a hash split together, with the sum of their sizes: no row in both, none in neither."""
    parts = A.hash_split(table(spark, sf, "labels"), ["doc_id"], 0.3)
    n = sum(p.count() for p in parts)
    return parts[0].unionByName(parts[1]).withColumn("n", F.lit(n).cast("long"))


@query(r"""select doc_id, line from (select doc_id, trim(unnest(string_split(text, chr(10)))) as line from documents)
where line <> '' and not regexp_full_match(line, '\p{L}+') and not regexp_full_match(line, '\p{Nd}+')""")
def caption_text(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.withColumn("line", F.trim("line")).filter(X.keep_caption_text(F.col("line")))
