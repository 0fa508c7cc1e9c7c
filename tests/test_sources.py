import datetime
import json

from pyspark.sql import functions as F

from riffle.functions.clean import drop_blank
from riffle.plans.corpus import image_manifest, slide_captions
from riffle.sources import readers as R
from riffle.sources import writers as W


def test_typed_csv_with_dates_and_replaced_header(spark, tmp_path):
    (tmp_path / "m.csv").write_text("a,b,c\nu1,20170105,3\nu2,,\n")
    df = R.read_typed_csv(spark, str(tmp_path / "m.csv"), "msno string, start date, bd int")
    assert [tuple(r) for r in df.collect()] == [("u1", datetime.date(2017, 1, 5), 3), ("u2", None, None)]


def test_gbk_csv(spark, tmp_path):
    (tmp_path / "k.csv").write_bytes("编号,城市\n1,广州\n".encode("gbk"))
    df = R.read_typed_csv(spark, str(tmp_path / "k.csv"), "no int, city string", encoding="GBK")
    assert tuple(df.first()) == (1, "广州")


def test_headerless_csv(spark, tmp_path):
    (tmp_path / "iris.data").write_text("5.1,3.5,1.4,0.2,Iris-setosa\n")
    df = R.read_typed_csv(spark, str(tmp_path / "iris.data"), "a double, b double, c double, d double, s string", header=False)
    assert tuple(df.select("c", "d", "s").first()) == (1.4, 0.2, "Iris-setosa")


def test_delimited_round_trip_turns_blank_to_missing(spark, tmp_path):
    df = spark.createDataFrame([("q1", "text, more", ",a.png"), ("q2", "t", "")], "quid string, qtext string, qimage string")
    W.write_delimited(df, str(tmp_path / "o"))
    back = R.read_typed_csv(spark, str(tmp_path / "o"), df.schema, sep="|")
    assert back.filter("qimage is null").count() == 1
    assert [r["quid"] for r in drop_blank(back, ["qimage"]).collect()] == ["q1"]


def test_json_array_and_chunks(spark, tmp_path):
    (tmp_path / "math.json").write_text(json.dumps([{"quid": "1", "qtext": ["a", "b"]}, {"quid": "2", "qtext": []}]))
    df = spark.read.schema("quid string, qtext array<string>").json(str(tmp_path / "math.json"), multiLine=True)
    assert df.count() == 2
    W.write_json_chunks(spark.range(10).coalesce(1), str(tmp_path / "c"), 4)
    assert len(list((tmp_path / "c").glob("*.json"))) == 3


def test_json_map(spark):
    df = spark.createDataFrame([('{"a.png": "3", "b.png": "x"}',)], "m string")
    assert sorted(map(tuple, R.manifest_from_json_map(df, "m").collect()), key=str) == [("a.png", 3), ("b.png", None)]


def test_image_manifest_and_label_folders(spark, tmp_path):
    for name in ("grade7/Resources/a.png", "grade8/Resources/b.JPG", "grade7/Resources/b.txt", "grade7/Other/c.png"):
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    files = R.file_manifest(spark, str(tmp_path / "in"), "Resources", (".jpeg", ".jpg", ".png"))
    rows = image_manifest(files)
    assert sorted((r["path"].split("/")[-1], r["label"]) for r in rows.collect()) == [("a.png", 7), ("b.JPG", 8)]
    W.write_by_label(rows, str(tmp_path / "out"), "label")
    assert sorted(r["label"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [7, 8]


def test_slide_captions(spark, tmp_path):
    slides = tmp_path / "deck" / "Slides"
    slides.mkdir(parents=True)
    (slides / "s1.xml").write_text(
        "<S><Picture><Source>res//p1</Source></Picture><Picture><Source>res//p2</Source></Picture>"
        "<RichText><Text>first caption</Text><Text>word</Text></RichText><RichText><Text> last one 2 </Text></RichText></S>"
    )
    (slides / "s2.xml").write_text("<S><Picture><Source>res//p3</Source></Picture><RichText><Text>123</Text></RichText></S>")
    (slides / "s3.xml").write_text("<S><Picture><Source>res//p2</Source></Picture><RichText><Text>later slide</Text></RichText></S>")
    docs = R.read_xml_fields(spark, str(slides), {"sources": "//Picture//Source/text()", "texts": "//RichText//Text/text()"})
    docs = docs.withColumn("scope", F.regexp_extract("path", "([^/]+)/Slides/", 1))
    files = spark.createDataFrame(
        [("deck", "p1.png"), ("deck", "p2_a.png"), ("deck", "p2_b.png"), ("deck", "p3.png"), ("other", "p1.png")], "scope string, name string"
    )
    got = {r["picture"]: r["caption"] for r in slide_captions(docs, files).collect()}
    assert got == {"p1.png": "last one 2", "p2_a.png": "later slide", "p2_b.png": "later slide"}


def test_predictions_and_sparse_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.123456), (2, 1.0)], "id int, target double")
    W.write_predictions(df.coalesce(1), str(tmp_path / "p"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "p")).collect()) == ["1,0.12346", "2,1.00000", "id,target"]
    W.write_sparse_text(spark.createDataFrame([(1, "1:5", None)], "t int, a string, b string"), str(tmp_path / "s"))
    assert spark.read.text(str(tmp_path / "s")).first()["value"] == "1 1:5"
