"""Sinks and sources: tables are written to the shared folder, read back by the library's readers, and compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riffle.functions import clean as C
from riffle.functions import text as X
from riffle.plans import corpus as K
from riffle.queries.features import NODES_SQL
from riffle.queries.registry import query, table
from riffle.session import shared_folder
from riffle.sources import readers as R
from riffle.sources import writers as W


def fresh_folder(spark) -> str:
    return f"{shared_folder(spark)}/riffle-tables/{uuid.uuid4().hex}"


@query("select o_orderkey as id, cast(o_orderdate as date) as day, o_totalprice as price from orders")
def dated_csv(spark, sf):
    """Orders as CSV with days like 19981003, by an explicit schema whose names differ from the header."""
    path = fresh_folder(spark)
    W.write_delimited(table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd"), "o_totalprice"), path, sep=",")
    return R.read_typed_csv(spark, path, "id long, day date, price double")


@query("select c_custkey as no, c_name || ' 编号' as name, '城市' || c_mktsegment as segment from customer")
def gbk_csv(spark, sf):
    """Customers in GBK, with names put over the header."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    path = fresh_folder(spark)
    rows = table(spark, sf, "customer").select("c_custkey", F.concat("c_name", F.lit(" 编号")), F.concat(F.lit("城市"), "c_mktsegment"))
    W.write_delimited(rows, path, sep=",", encoding="GBK")
    return R.read_typed_csv(spark, path, "no long, name string, segment string", encoding="GBK")


@query("select page_id, url, length(html) as size from pages")
def bar_separated(spark, sf):
    path = fresh_folder(spark)
    W.write_delimited(table(spark, sf, "pages").select("page_id", "url", F.length("html").alias("size")), path)
    return R.read_typed_csv(spark, path, "page_id long, url string, size int", sep="|")


@query("select l_orderkey as order_key, l_partkey as part, cast(l_quantity as double) as quantity from lineitem")
def json_arrays(spark, sf):
    """Lines of each order as a JSON array, read back one row per element."""
    path = fresh_folder(spark)
    line = F.struct(F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("part"), F.col("l_quantity").cast("double").alias("quantity"))
    table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(line)).alias("value")).select("value").write.text(path)
    return spark.read.schema("order_key long, part long, quantity double").json(path)


@query("select event_id, event_type, value, true as cut from events")
def json_chunks(spark, sf):
    """Events in JSON files, and whether these hold a thousand rows at most each."""
    path = fresh_folder(spark)
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    W.write_json_chunks(events, path, 1000)
    back = spark.read.schema(events.schema).json(path)
    sizes = back.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count"), F.count(F.lit(1)), F.sum("count")).first()
    cut = (sizes[0] or 0) <= 1000 and sizes[1] * 1000 >= (sizes[2] or 0)
    return back.withColumn("cut", F.lit(cut))


@query("select quality as label, count(*) as n, sum(doc_id) as ids from labels where quality is not null group by 1")
def label_folders(spark, sf):
    """Rows of each label's folder, for the labels that the file listing finds in the paths."""
    path = fresh_folder(spark)
    W.write_by_label(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("grade")), path, "grade")
    files = R.file_manifest(spark, path, exts=(".parquet",)).where("length > 0")
    named = files.select(F.regexp_replace("path", "grade=", "grade").alias("path"), C.file_extension(F.col("path")).alias("ext"))
    labels = K.image_manifest(named.where("ext = '.parquet'")).select("label").distinct()
    rows = spark.read.parquet(path).groupBy(F.col("grade").alias("label")).agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))
    return rows.join(labels, "label")


@query("select s_nationkey as nation, s_name as supplier, s_suppkey as no from supplier")
def xml_fields(spark, sf):
    """One XML file per nation with its suppliers; names and numbers by XPath."""
    path = fresh_folder(spark)
    one = F.concat(F.lit("<s no='"), "s_suppkey", F.lit("'><n>"), "s_name", F.lit("</n></s>"))
    docs = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.concat(F.lit("<all>"), F.array_join(F.collect_list(one), ""), F.lit("</all>")).alias("value"))
    docs.repartition("s_nationkey").write.partitionBy("s_nationkey").text(path)
    found = R.read_xml_fields(spark, path, {"names": "//s/n/text()", "numbers": "//s/@no"})
    pairs = found.select("path", F.explode(F.arrays_zip("names", "numbers")).alias("p"))
    nation = F.regexp_extract("path", r"s_nationkey=(\d+)", 1).cast("int")
    return pairs.select(nation.alias("nation"), F.col("p.names").alias("supplier"), F.col("p.numbers").cast("long").alias("no"))


@query("select c_custkey as id, printf('%.5f', cast(c_acctbal as double) / 7) as target from customer")
def prediction_csv(spark, sf):
    path = fresh_folder(spark)
    W.write_predictions(table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_acctbal").cast("double") / 7).alias("target")), path)
    return R.read_typed_csv(spark, path, "id long, target string")


@query("select concat_ws(' ', l_orderkey, l_linenumber, l_partkey, l_suppkey) as value from lineitem")
def sparse_text(spark, sf):
    path = fresh_folder(spark)
    W.write_sparse_text(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), path)
    return spark.read.text(path)


@query("select doc_id, case when quality = 0 then -1 else 1 end as sign from labels where quality is not null")
def signed_quality(spark, sf):
    return table(spark, sf, "labels").where("quality is not null").select("doc_id", C.signed_label(F.col("quality"), 0).alias("sign"))


@query(r"""with p as (select page_id, url, page_id % 3 = 0 as odd, url || case when page_id % 3 = 0 then '\x' else '' end as u from pages),
l as (select *, regexp_extract(u, '(example.*)', 1) as found from p)
select page_id, case when contains(found, '\') then left(found, length(found) - 1) else found end as local, substr(u, 8) as remote,
nullif(regexp_extract(url, 'page=(.)', 1), '') as page, case when len(string_split(url, '//')) > 1 then string_split(url, '//')[2] end as source from l""")
def path_parts(spark, sf):
    """Local and remote paths of pages (every third with a backslash), the character after a word, and the part after the double slash."""
    marked = F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit("\\x"))).otherwise(F.col("url"))
    local, remote = C.asset_path(marked, "example", 7)
    return table(spark, sf, "pages").select(
        "page_id", local.alias("local"), remote.alias("remote"), C.char_after(F.col("url"), "page=").alias("page"), X.source_id(F.col("url")).alias("source")
    )


@query(r"""with lines as (select doc_id, source as scope, 'img' || (doc_id % 40) as picture, string_split(text, chr(10)) as texts from documents where text is not null),
t as (select doc_id, scope, picture, unnest(texts) as raw, generate_subscripts(texts, 1) as at_ from lines),
kept as (select doc_id, scope, picture, at_, trim(raw, ' ' || chr(9) || chr(10) || chr(13)) as x from t),
good as (select * from kept where x <> '' and not regexp_full_match(x, '\p{L}+') and not regexp_full_match(x, '\p{Nd}+')),
captions as (select doc_id, any_value(scope) as scope, any_value(picture) as picture, arg_max(x, at_) as caption from good group by doc_id),
files as (select distinct source as scope, 'img' || (doc_id % 40) || '.png' as name from documents),
shown as (select name, caption, lpad(cast(doc_id as varchar), 12, '0') as path from files f join captions c on f.scope = c.scope and starts_with(f.name, c.picture))
select name as picture, arg_max(caption, path) as caption from shown group by name""")
def picture_captions(spark, sf):
    """Pictures of each source with the last fitting line of the last document that shows them."""
    docs = table(spark, sf, "documents")
    picture = F.concat(F.lit("img"), (F.col("doc_id") % 40).cast("string"))
    slides = docs.where("text is not null").select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("path"), F.col("source").alias("scope"),
        F.array(F.concat(F.lit("pictures//"), picture)).alias("sources"), F.split("text", "\n").alias("texts"),
    )
    files = docs.select(F.col("source").alias("scope"), F.concat(picture, F.lit(".png")).alias("name")).distinct()
    return K.slide_captions(slides, files)


@query(f"""with {NODES_SQL}, size as (select lang, count(*) as n from documents group by lang),
fit as (select doc_id from documents d join size s on d.lang = s.lang where n % 2 = 0 or n > (select avg(n) from size))
select page_id as question_uid, url, array_to_string(list(node order by pos), '') as qtext, ',img/' || page_id || '.png' as qimage
from nodes where page_id in (select doc_id from fit) group by page_id, url""")
def corpus_with_assets(spark, sf):
    """Pages with a picture each, kept where the document of the same number is of a language that meets the condition."""
    shown = F.concat("html", F.lit('<img src="img/'), "page_id", F.lit('.png">'))
    questions = table(spark, sf, "pages").select(F.col("page_id").alias("question_uid"), "url", shown.alias("html"))
    docs = table(spark, sf, "documents")
    links = docs.select(F.col("doc_id").alias("question_uid"), F.col("lang").alias("knowledge_uid"))
    knowledge = docs.groupBy(F.col("lang").alias("knowledge_uid")).agg(F.count(F.lit(1)).alias("size"))
    mean = knowledge.agg(F.avg("size")).first()[0] or 0.0
    wanted = (F.col("size") % 2 == 0) | (F.col("size") > mean)
    return K.build_question_corpus(questions, links, knowledge, wanted, ["html"], order=["url"], how="inner")
