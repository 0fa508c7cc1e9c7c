"""Derived columns, pages and documents, sparse rows, content match."""

from __future__ import annotations

from pyspark.sql import functions as F

from riffle.functions import clean as C
from riffle.functions import text as X
from riffle.functions import vectors as V
from riffle.operators import aggregates as A
from riffle.plans import corpus as K
from riffle.plans import embed as E
from riffle.plans.matching import Close, Equal, Shared, match_ratio
from riffle.plans.songs import song_features as build_song_features
from riffle.plans.sparse import sparse_rows
from riffle.queries import standin as S
from riffle.queries.registry import query, table
from riffle.sources.readers import manifest_from_json_map


@query(f"""with {S.SQL} select s.song_id, song_year, song_area from songs s left join code_cols c on s.song_id = c.song_id""")
def isrc_features(spark, sf):
    out = S.songs(spark, sf).select("song_id").join(S.codes(spark, sf), "song_id", "left")
    return out.select("song_id", C.isrc_year(F.col("isrc")).alias("song_year"), C.isrc_area(F.col("isrc")).alias("song_area"))


SPLIT = r"'[/\\;|&]'"


@query(f"""with {S.SQL} select song_id,
case when lyricist is null then 0 else len(regexp_extract_all(lyricist, '[|/\\\\;]')) + 1 end as lyricists,
case when composer is null then 0 else len(regexp_extract_all(composer, '[|/\\\\;]')) + 1 end as composers,
case when artist_name like '%feat%' then 1 else 0 end as featured,
case when artist_name is null then 0 else len(regexp_extract_all(artist_name, 'and|,|feat|&')) end as artists,
case when artist_name = composer then 1 else 0 end as artist_composer,
case when artist_name = composer and composer = lyricist then 1 else 0 end as all_three,
case when contains(language, '17.0') or contains(language, '45.0') then 1 else 0 end as lang_flag,
array_to_string(regexp_split_to_array(artist_name, {SPLIT}), '|') as artist_bars,
regexp_split_to_array(lyricist, {SPLIT})[1] as first_lyricist,
case when song_length < (select avg(song_length) from songs) then 1 else 0 end as shorter,
case when song_length <= (select avg(song_length) from songs) then 1 when song_length is not null then 2 end as bucket
from songs""")
def writer_counts(spark, sf):
    songs = A.mean_bucket(A.below_mean(S.songs(spark, sf), "song_length", "shorter"), "song_length", "bucket")
    artist, composer, lyricist = F.col("artist_name"), F.col("composer"), F.col("lyricist")
    return songs.select(
        "song_id",
        C.writer_count(lyricist).alias("lyricists"),
        C.writer_count(composer).alias("composers"),
        C.is_featured(artist).alias("featured"),
        C.artist_count(artist).alias("artists"),
        C.same_value(artist, composer).alias("artist_composer"),
        C.same_value(artist, composer, lyricist).alias("all_three"),
        C.contains_any(F.col("language"), C.FLAGGED_LANGUAGES).alias("lang_flag"),
        C.normalize_tags(artist).alias("artist_bars"),
        C.first_tag(lyricist).alias("first_lyricist"),
        "shorter",
        "bucket",
    )


@query(f"with {S.SQL} select * from member_cols")
def tenure(spark, sf):
    from riffle.plans.songs import member_columns

    return member_columns(S.members(spark, sf))


@query("""select page_id, pos, href from (select page_id, unnest(h) as href, generate_subscripts(h, 1) as pos from (
select page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) as h from pages))""")
def html_links(spark, sf):
    pages = table(spark, sf, "pages")
    found = pages.select("page_id", F.posexplode(X.html_links(F.col("html"))).alias("pos", "href"))
    return found.withColumn("pos", F.col("pos") + 1)


@query(r"""with e as (select page_id, unnest(regexp_extract_all(html, '<(?:a href="[^"]*"|div class="[^"]*")')) as e,
generate_subscripts(regexp_extract_all(html, '<(?:a href="[^"]*"|div class="[^"]*")'), 1) as at_ from pages)
select page_id, row_number() over (partition by page_id order by at_) as pos, string_split(e, '"')[2] as asset from e
where e like '<a %' or string_split(e, '"')[2] <> ''""")
def html_assets(spark, sf):
    """Image sources and style urls of pages whose links and classes stand as images and backgrounds."""
    shown = F.regexp_replace(F.regexp_replace("html", '<a href="', '<img src="'), '<div class="([^"]*)"', """<div style="background:url('$1')\"""")
    found = table(spark, sf, "pages").select("page_id", F.posexplode(X.html_assets(shown)).alias("pos", "asset"))
    return found.withColumn("pos", F.col("pos") + 1)


# Text nodes by pattern: code and comments out, cut at tags, entities, punctuation.
NODES_SQL = r"""
cut as (select page_id, url, regexp_split_to_array(regexp_replace(regexp_replace(html,
    '<(script|style)[^>]*>.*?</(script|style)>', '<x>', 'gs'), '<!--.*?-->', '<x>', 'gs'), '<[^>]*>') as parts from pages),
listed as (select page_id, url, unnest(parts) as raw, generate_subscripts(parts, 1) as at_ from cut),
plain as (select page_id, url, at_, regexp_replace(replace(replace(replace(raw, '&copy;', '©'), '&middot;', '·'),
    '&quot;', '"'), '&amp;?', '&', 'g') as t from listed),
clean as (select page_id, url, at_, translate(t, concat('!"#$%&()*+,-./:;<=>?@[\]^_`{|}~', chr(39)), '') as node from plain),
nodes as (select page_id, url, node, row_number() over (partition by page_id order by at_) - 1 as pos from clean
    where node <> '' and not contains(node, chr(10)))
"""


@query(f"with {NODES_SQL} select page_id, pos, node from nodes")
def html_text(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(X.html_texts(F.col("html"))).alias("pos", "node"))


@query(f"""with {NODES_SQL},
texts as (select page_id, url, array_to_string(list(node order by pos), '') as qtext from nodes group by page_id, url),
e as (select page_id, unnest(regexp_extract_all(html, '<(?:a href="[^"]*"|div class="[^"]*")')) as e,
  generate_subscripts(regexp_extract_all(html, '<(?:a href="[^"]*"|div class="[^"]*")'), 1) as at_ from pages),
assets as (select page_id, concat(',', array_to_string(list(string_split(e, '"')[2] order by at_), ',')) as qimage from e where e like '<a %' or string_split(e, '"')[2] <> '' group by page_id),
k as (select lang from documents where lang is not null group by lang having count(*) < (select count(*) / count(distinct lang) from documents where lang is not null))
select page_id as question_uid, url, qtext, qimage from texts join assets using (page_id)
where trim(qtext) <> '' and trim(qimage) <> '' and page_id in (select doc_id from documents where lang in (select lang from k))""")
def corpus_build(spark, sf):
    """Pages as questions, whose links and classes stand as images and backgrounds; the document of the same number is the
    link, its language the knowledge.  Only pages of the rarer languages stay, and of those the ones with text and assets."""
    shown = F.regexp_replace(F.regexp_replace("html", '<a href="', '<img src="'), '<div class="([^"]*)"', """<div style="background:url('$1')\"""")
    questions = table(spark, sf, "pages").select(F.col("page_id").alias("question_uid"), "url", shown.alias("html"))
    docs = table(spark, sf, "documents").filter("lang is not null")
    links = docs.select(F.col("doc_id").alias("question_uid"), F.col("lang").alias("knowledge_uid"))
    whole = docs.agg((F.count(F.lit(1)) / F.count_distinct("lang")).alias("mean")).first()[0] or 0.0
    knowledge = docs.groupBy(F.col("lang").alias("knowledge_uid")).agg(F.count(F.lit(1)).alias("size"))
    return K.build_question_corpus(questions, links, knowledge, F.col("size") < whole, ["html"], order=["url"], how="inner")


@query("""select path, cast(try_cast(label as int) as int) as label from (
select event_id as path, json_extract_string(props, '$.k') as label from events)""")
def json_map_labels(spark, sf):
    events = table(spark, sf, "events")
    keyed = events.select(F.to_json(F.create_map(F.col("event_id").cast("string"), F.get_json_object("props", "$.k"))).alias("m"))
    return manifest_from_json_map(keyed, "m").withColumn("path", F.col("path").cast("long"))


EXAM_MARK = "case when n_chars < 300 then 'A1' when n_chars < 600 then 'X' else '案例题' end"


@query(f"""with p as (select source as "subType", lang as "subCon", {EXAM_MARK} as marker, text,
  list_filter(string_split(text, chr(10)), lambda x: x <> '') as opts from documents)
select "subType", "subCon",
case when marker = 'A1' then '单选题' when marker = 'X' then '多选题' else '简答题' end as "queType",
concat(string_split(text, ' ')[1], '<', "subType", '>') as "queCon",
{', '.join(f'''case when marker = '案例题' then '' else coalesce(opts[{i}], '') end as "queAns{c}"''' for i, c in enumerate('ABCDE', 1))},
case when contains(replace(text, chr(10), ''), 'the') then substr(replace(text, chr(10), ''), instr(replace(text, chr(10), ''), 'the')) else replace(text, chr(10), '') end as "quePar"
from p""")
def exam_items(spark, sf):
    docs = table(spark, sf, "documents").selectExpr(
        "source as sub_type", "lang as sub_con", f"{EXAM_MARK} as marker", "split_part(text, ' ', 1) as stem",
        "array(source) as images", "split(text, '\n') as options", "text as answer",
    )
    return K.exam_items(docs, "the")


@query("""select doc_id, regexp_extract(text, '(\\d+\\.?\\d*)', 1) as num from documents where regexp_matches(text, '\\d')""")
def first_numbers(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", X.first_number(F.col("text")).alias("num"))
    return docs.filter(F.col("num").isNotNull())


@query(f"""with {S.SQL},
enc as (select *, case gender when 'BUILDING' then 1 when 'FURNITURE' then 2 else 0 end as gender_code from wide),
v_tab as (select distinct source_system_tab as v from facts), v_screen as (select distinct source_screen_name as v from facts),
v_type as (select distinct source_type as v from facts), v_user as (select distinct msno as v from facts),
v_song as (select distinct song_id as v from facts), v_area as (select distinct song_area as v from wide where song_area is not null),
{', '.join(f'''v_{c} as (select distinct unnest(regexp_split_to_array({c}, {SPLIT})) as v from songs
  where {c} is not null and song_id in (select song_id from facts))''' for c in ('artist_name', 'composer', 'lyricist'))},
{', '.join(f'''r_{t} as (select v, row_number() over (order by v) as r from v_{t})''' for t in ('tab', 'screen', 'type', 'user', 'song', 'area', 'artist_name', 'composer', 'lyricist'))},
f as (select {', '.join('enc.' + c for c in S.ID)}, target,
 [concat('1:', a.r), concat('2:', b.r), concat('3:', c.r)] as g,
 list_filter([concat('1:', u.r), case when city <> 0 then concat('2:', city) end, case when bd > 0 and bd < 100 then concat('3:', bd) end,
   case when gender_code <> 0 then concat('4:', gender_code) end, case when registered_via <> 0 then concat('5:', registered_via) end,
   case when membership_days <> 0 then concat('6:', membership_days) end], lambda x: x is not null) as m,
 list_filter([concat('1:', s.r), case when language <> '0' then concat('2:', language) end, case when song_length <> 0 then concat('3:', song_length) end,
   case when song_year <> 0 then concat('4:', song_year) end, '5:' || ar.r, '6:' || string_split(genre_ids, '|')[1],
   '7:' || n.r, '8:' || co.r, '9:' || ly.r], lambda x: x is not null) as i
 from enc left join r_tab a on source_system_tab = a.v left join r_screen b on source_screen_name = b.v
 left join r_type c on source_type = c.v left join r_user u on msno = u.v left join r_song s on song_id = s.v
 left join r_area ar on song_area = ar.v left join r_artist_name n on regexp_split_to_array(artist_name, {SPLIT})[1] = n.v
 left join r_composer co on regexp_split_to_array(composer, {SPLIT})[1] = co.v
 left join r_lyricist ly on regexp_split_to_array(lyricist, {SPLIT})[1] = ly.v)
select {', '.join(S.ID)}, concat_ws(' ', target, len(g), len(m), len(i), array_to_string(g, ' '), array_to_string(m, ' '), array_to_string(i, ' ')) as value from f""")
def sparse_features(spark, sf):
    facts = S.fact_rows(spark, sf)
    wide = S.wide_rows(spark, sf, facts).withColumn("gender_code", C.map_codes(F.col("gender"), {"BUILDING": 1, "FURNITURE": 2}, 0))
    context = facts.select("source_system_tab", "source_screen_name", "source_type", "msno", "song_id")
    heard = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("song_id")).distinct()
    songs = S.songs(spark, sf).join(heard, "song_id", "left_semi").select("artist_name", "composer", "lyricist")
    areas = S.codes(spark, sf).join(heard, "song_id", "left_semi").select(C.isrc_area(F.col("isrc")).alias("song_area"))
    return sparse_rows(wide, [context, songs, areas], keep=S.ID)


MEMBER_OUT = (
    "city, bd, gender, registered_via, membership_days, registration_year, registration_month, registration_day, "
    "expiration_year, expiration_month, expiration_day, song_year, song_area, language"
)


@query(f"""with {S.SQL},
tr as (select s.song_id, coalesce(song_length, 200000) as len, coalesce(artist_name, 'no_artist') as a from facts f left join songs s on f.song_id = s.song_id where l_linestatus = 'F'),
te as (select s.song_id, coalesce(artist_name, 'no_artist') as a from facts f left join songs s on f.song_id = s.song_id where l_linestatus = 'O'),
trs as (select song_id, count(*) n from tr group by 1), tes as (select song_id, count(*) n from te group by 1),
tra as (select a, count(*) n from tr group by 1), tea as (select a, count(*) n from te group by 1),
b as (select wide.* replace (coalesce(song_length, 200000) as song_length, coalesce(artist_name, 'no_artist') as artist_name,
        coalesce(composer, 'no_composer') as composer, coalesce(lyricist, 'no_lyricist') as lyricist)
      from wide),
x as (select {', '.join(S.ID)}, target, {MEMBER_OUT}, song_length,
 case when lyricist = 'no_lyricist' then 0 else len(regexp_extract_all(lyricist, '[|/\\\\;]')) + 1 end as lyricists_count,
 case when composer = 'no_composer' then 0 else len(regexp_extract_all(composer, '[|/\\\\;]')) + 1 end as composer_count,
 case when contains(artist_name, 'feat') then 1 else 0 end as is_featured,
 case when artist_name = 'no_artist' then 0 else len(regexp_extract_all(artist_name, 'and|,|feat|&')) end as artist_count,
 case when artist_name = composer then 1 else 0 end as artist_composer,
 case when artist_name = composer and composer = lyricist then 1 else 0 end as artist_composer_lyricist,
 case when contains(language, '17.0') or contains(language, '45.0') then 1 else 0 end as song_lang_boolean,
 case when song_length < (select avg(len) from tr) then 1 else 0 end as smaller_song,
 coalesce(trs.n, tes.n, 0) as count_song_played, coalesce(tra.n, tea.n, 0) as count_artist_played,
 regexp_split_to_array(artist_name, {SPLIT}) as atags, coalesce(regexp_split_to_array(genre_ids, {SPLIT}), [null]) as gt
 from b left join trs on b.song_id = trs.song_id left join tes on b.song_id = tes.song_id
 left join tra on b.artist_name = tra.a left join tea on b.artist_name = tea.a),
y as (select * exclude (atags), unnest(atags) as artist_tag from x)
select * exclude (gt), unnest(gt) as genre_tag from y""")
def song_features(spark, sf):
    train, test = S.split(S.fact_rows(spark, sf))
    out = build_song_features(S.fact_rows(spark, sf), train, test, S.members(spark, sf), S.songs(spark, sf), S.codes(spark, sf))
    return out.drop("msno", "song_id", "source_system_tab", "source_screen_name", "source_type", "composer", "lyricist", "l_linestatus")


@query(f"""with {S.SQL}, top as (select composer, arg_max(lyricist, song_id) as best from songs where lyricist is not null group by 1)
select song_id, case when len(list_intersect(regexp_split_to_array(lyricist, {SPLIT}), regexp_split_to_array(best, {SPLIT}))) > 0 then true else false end as same_tag,
case when len(list_intersect(regexp_split_to_array(artist_name, {SPLIT}), regexp_split_to_array(lyricist, {SPLIT}))) > 0 then true else false end as own_tag
from songs s left join top t on s.composer = t.composer""")
def tag_overlap(spark, sf):
    """Each song against the newest song of its composer, and its own two tag fields."""
    songs = S.songs(spark, sf)
    top = A.last_by(songs.filter("lyricist is not null"), "composer", "song_id", ["lyricist"]).withColumnRenamed("lyricist", "best")
    return songs.join(top, "composer", "left").select(
        "song_id",
        C.shares_tag(F.col("lyricist"), F.col("best")).alias("same_tag"),
        C.shares_tag(F.col("artist_name"), F.col("lyricist")).alias("own_tag"),
    )


TESTS = [
    *[Equal(c) for c in (
        "source_system_tab", "source_screen_name", "source_type", "language", "city", "bd", "gender",
        "registered_via", "membership_days", "song_year", "song_area",
    )],
    Close("song_length", 30_000),
    Shared("genre_ids", C.GENRE_SEP),
    *[Shared(c) for c in ("artist_name", "composer", "lyricist")],
]
KEYS = {
    "msno": ("city", "bd", "gender", "registered_via", "membership_days"),
    "song_id": ("language", "song_year", "song_area", "song_length", "genre_ids", "artist_name", "composer", "lyricist"),
}
_EQ = ["source_system_tab", "source_screen_name", "source_type", "language", "city", "bd", "gender", "registered_via", "membership_days", "song_year", "song_area"]
MATCH_COUNT = " + ".join(
    [f"case when q.{c} = t.{c} then 1 else 0 end" for c in _EQ]
    + ["case when q.song_length <> 0 and t.song_length <> 0 and abs(q.song_length - t.song_length) < 30000 then 1 else 0 end"]
    + [f"case when len(list_intersect(q.{c}, t.{c})) > 0 then 1 else 0 end" for c in ("genre_ids", "artist_name", "composer", "lyricist")]
)


@query(f"""with {S.SQL},
w as (select * replace (string_split(genre_ids, '|') as genre_ids, regexp_split_to_array(artist_name, {SPLIT}) as artist_name,
   regexp_split_to_array(composer, {SPLIT}) as composer, regexp_split_to_array(lyricist, {SPLIT}) as lyricist) from wide),
p as (select {', '.join('q.' + c for c in S.ID)}, {MATCH_COUNT} as n from w q join w t on q.msno = t.msno where q.l_linestatus = 'O' and t.l_linestatus = 'F'
  union all select {', '.join('q.' + c for c in S.ID)}, {MATCH_COUNT} as n from w q join w t on q.song_id = t.song_id where q.l_linestatus = 'O' and t.l_linestatus = 'F')
select {', '.join('f.' + c for c in S.ID)}, coalesce(max(n), 0) / 16.0 as score from facts f left join p using ({', '.join(S.ID)})
where f.l_linestatus = 'O' group by all""")
def content_match(spark, sf):
    train, test = S.split(S.wide_rows(spark, sf))
    return match_ratio(test, train, KEYS, TESTS).select(*S.ID, "score")


REGION_TESTS = [Equal("source_system_tab"), Equal("gender"), Close("song_length", 30_000), Close("bd", 5), Shared("composer")]


@query(f"""with {S.SQL},
w as (select l_linestatus, registered_via as k, source_system_tab as a, gender as b, nullif(song_length, 0) as x, nullif(bd, 0) as y, composer,
   regexp_split_to_array(composer, {SPLIT}) as c from wide),
q as (select distinct k, a, b, x, y, composer, c from w where l_linestatus = 'O'), t as (select distinct k, a, b, x, y, c from w where l_linestatus = 'F'),
p as (select q.k, q.a, q.b, q.x, q.y, q.composer, max(coalesce((q.a = t.a)::int, 0) + coalesce((q.b = t.b)::int, 0) + coalesce((abs(q.x - t.x) < 30000)::int, 0)
   + coalesce((abs(q.y - t.y) < 5)::int, 0) + coalesce(list_has_any(q.c, t.c)::int, 0)) as n from q join t on q.k = t.k group by all)
select {', '.join(S.ID)}, coalesce(n, 0) / 5.0 as score from wide f left join p on f.registered_via = p.k and f.source_system_tab is not distinct from p.a
  and f.gender is not distinct from p.b and nullif(f.song_length, 0) is not distinct from p.x and nullif(f.bd, 0) is not distinct from p.y
  and f.composer is not distinct from p.composer where l_linestatus = 'O'""")
def content_match_regions(spark, sf):
    """Open lines against all finished lines of their region: five keys hold all rows, two tests are tolerances."""
    train, test = S.split(S.wide_rows(spark, sf))
    return match_ratio(test, train, {"registered_via": ()}, REGION_TESTS).select(*S.ID, "score")


@query("""with d as (select label, i, avg(x) as c from (select label, generate_subscripts(embedding, 1) as i, cast(unnest(embedding) as double) as x from embeddings) group by all),
c as (select label, list(c order by i) as c, avg(c) as mc from d group by label),
e as (select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
j as (select vec_id, v, c, list_avg(v) as mv, mc from e join c using (label)),
k as (select vec_id, v, c, list_transform(v, lambda x: x - mv) as vv, list_transform(c, lambda x: x - mc) as cc from j)
select vec_id, round(1 / (1 + sqrt(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))), 6) as euclid,
round(0.5 + 0.5 * list_cosine_similarity(v, c), 6) as cosine, round(0.5 + 0.5 * list_cosine_similarity(vv, cc), 6) as pearson from k""")
def item_similarity(spark, sf):
    """Each vector against the mean vector of its label."""
    vectors = table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    size = 64
    means = vectors.groupBy("label").agg(*[F.avg(F.col("v")[j]).alias(f"m{j}") for j in range(size)])
    centre = means.select("label", F.array(*[F.col(f"m{j}") for j in range(size)]).alias("c"))
    a, b = F.col("v"), F.col("c")
    return vectors.join(centre, "label").select(
        "vec_id",
        F.round(V.sim_euclid(a, b), 6).alias("euclid"),
        F.round(V.sim_cosine(a, b), 6).alias("cosine"),
        F.round(V.sim_pearson(a, b), 6).alias("pearson"),
    )


@query()
def embed_documents(spark, sf):
    return E.embed_column(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("""select vec_id, d, x from (select vec_id, unnest(range(1, 130)) as d, unnest(list_concat(embedding, [cast(n_chars as float)], embedding)) as x
from embeddings join documents on vec_id = doc_id) where x is not null""")
def combine_vectors(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), F.array(F.col("n_chars").cast("float")).alias("size"))
    rows = table(spark, sf, "embeddings").withColumnRenamed("embedding", "a").withColumn("b", F.col("a")).join(docs, "vec_id")
    long = E.combine_vectors(rows, ["a", "size", "b"]).select("vec_id", F.posexplode("combined").alias("d", "x"))
    return long.withColumn("d", F.col("d") + 1)
