import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riffle.functions import clean as C
from riffle.functions import text as X
from riffle.functions import vectors as V


def one(spark, value, fn, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(fn(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("code, year", [("GBABC17", 2017), ("GBABC18", 1918), ("GBABC00", 2000), ("GBABC99", 1999), (None, None), ("GB", None), ("GBABCxx", None)])
def test_isrc_year(spark, code, year):
    assert one(spark, code, C.isrc_year) == year


def test_isrc_area(spark):
    assert one(spark, "USABC17", C.isrc_area) == "US" and one(spark, None, C.isrc_area) is None


@pytest.mark.parametrize("text, n", [("a", 1), ("a|b", 2), ("a/b", 2), ("a\\b", 2), ("a;b", 2), ("a&b", 1), ("a|b/c\\d;e", 5), (None, 0), ("", 1)])
def test_writer_count(spark, text, n):
    assert one(spark, text, C.writer_count) == n


def test_tags_split_on_all_five(spark):
    assert one(spark, "a/b\\c;d|e&f", C.tags) == list("abcdef")
    assert one(spark, "a/b\\c;d|e&f", C.normalize_tags) == "a|b|c|d|e|f"
    assert one(spark, "x&y", C.first_tag) == "x" and one(spark, None, C.first_tag) is None


def test_artist_fields(spark):
    assert one(spark, "A feat B, C & D and E", C.artist_count) == 4
    assert [one(spark, v, C.artist_count) for v in ("群星", "佚名", "no_artist", None, "Solo")] == [0, 0, 0, 0, 0]
    assert [one(spark, v, C.is_featured) for v in ("A feat. B", "A", None)] == [1, 0, 0]
    assert [one(spark, v, lambda c: C.contains_any(c, C.FLAGGED_LANGUAGES)) for v in ("17.0", "45.0", "3.0", None)] == [1, 1, 0, 0]


def test_comparisons(spark):
    df = spark.createDataFrame([("a", "a", 10, 20), ("a", None, 0, 5), (None, None, 10, 40_010)], "x string, y string, n int, m int")
    got = df.select(
        C.same_value(F.col("x"), F.col("y")).alias("s"), C.equal_present(F.col("x"), F.col("y")).alias("e"),
        C.close_to(F.col("n"), F.col("m"), 30_000).alias("c"),
    ).collect()
    assert [tuple(r) for r in got] == [(1, True, True), (0, False, False), (0, False, False)]


def test_explode_tags_keeps_missing(spark):
    df = spark.createDataFrame([(1, "a|b"), (2, None)], "id int, t string")
    assert sorted((r["id"], r["tag"] or "") for r in C.explode_tags(df, "t", "tag").collect()) == [(1, "a"), (1, "b"), (2, "")]
    assert C.explode_tags(df, "t", "tag", keep_missing=False).count() == 2


def test_blank_and_missing(spark):
    df = spark.createDataFrame([("x", 1), ("", 2), (None, 3), ("y", None)], "t string, n int")
    assert C.drop_blank(df, ["t"]).count() == 2 and C.drop_blank(df, ["t", "n"]).count() == 1
    filled = C.fill_missing(df, {"t": "no", "n": F.lit(7)})
    assert [tuple(r) for r in filled.collect()] == [("x", 1), ("", 2), ("no", 3), ("y", 7)]
    assert C.cast_by_type(df, "int", "string").dtypes == [("t", "string"), ("n", "string")]


def test_codes_and_labels(spark):
    assert [one(spark, v, lambda c: C.map_codes(c, {"male": 1, "female": 2}, 0)) for v in ("male", "female", None)] == [1, 2, 0]
    assert [one(spark, v, lambda c: C.signed_label(c, "setosa")) for v in ("setosa", "other")] == [-1, 1]


def test_sparse_features_leave_out_nulls(spark):
    df = spark.createDataFrame([(1, "u", None, 5)], "t int, a string, b string, c int")
    got = df.select(C.sparse_features([[(1, F.col("a")), (2, F.col("b"))], [(3, F.col("c"))], [(1, F.col("b"))]], F.col("t"))).first()[0]
    assert got == "1 1 1 0 1:u 3:5"


def test_asset_paths(spark):
    prefix = "ftp://10.0.0.1/x/"
    path = prefix + "images/upimages/a.png"
    df = spark.createDataFrame([(path,), (path + "\\",)], "p string")
    local, remote = C.asset_path(F.col("p"), "upimages", len(prefix))
    assert [tuple(r) for r in df.select(local, remote).collect()] == [
        ("upimages/a.png", "images/upimages/a.png"), ("upimages/a.png", "images/upimages/a.png\\"),
    ]
    assert one(spark, "/x/grade7/Resources/a.b.PNG", lambda c: C.char_after(c, "grade")) == "7"
    assert one(spark, "/x.y/a.b.PNG", C.file_extension) == ".PNG" and one(spark, "/x.y/none", C.file_extension) == ""


PAGE = (
    '<p>One, two!</p><script>var a=1;</script><style>p{}</style><div style="background:url(\'bg.png\') x">Three &amp; four\n</div>'
    '<img alt="z" src="a.png"/><div style="color:red">...</div><b>Five</b>'
)


def test_html_text(spark):
    assert one(spark, PAGE, X.html_texts) == ["One two", "Five"]
    assert one(spark, PAGE, lambda c: X.html_texts(c, skip_code=False)) == ["One two", "var a1", "p", "Five"]
    assert one(spark, None, X.html_texts) is None


def test_html_assets(spark):
    assert one(spark, PAGE, X.html_image_sources) == ["a.png"]
    assert one(spark, PAGE, X.html_style_urls) == ["bg.png"]
    assert one(spark, PAGE, X.html_assets) == ["bg.png", "a.png"]
    assert one(spark, '<a href="/x">y</a>', X.html_links) == ["/x"]


@pytest.mark.parametrize("text, keep", [("  ", False), ("word", False), ("123", False), ("a1", True), ("two words", True), (" 单词 ", False), (None, False), ("\n", False)])
def test_caption_filter(spark, text, keep):
    assert one(spark, text, X.keep_caption_text) is keep


@pytest.mark.parametrize("mark, kind", [("A1型题", "单选题"), ("B", "单选题"), ("X型题", "多选题"), ("案例题", "简答题"), ("简答题", "简答题"), ("?", None)])
def test_question_type(spark, mark, kind):
    assert one(spark, mark, X.question_type) == kind


def test_exam_text(spark):
    assert one(spark, "x\n正确答案:A\n解析", lambda c: X.tail_from(c, X.ANSWER_MARK)) == "正确答案:A解析"
    assert one(spark, "no\nmark", lambda c: X.tail_from(c, X.ANSWER_MARK)) == "nomark"
    assert one(spark, "共 12.5 题 3", X.first_number) == "12.5" and one(spark, "none", X.first_number) is None
    assert one(spark, "file//id9", X.source_id) == "id9" and one(spark, "plain", X.source_id) is None
    opts = spark.createDataFrame([(["a", "", "b", None, "c", "d"],)], "o array<string>")
    assert tuple(opts.select(*X.option_columns(F.col("o"), "ABCDE")).first()) == ("a", "b", "c", "d", "")
    assert one(spark, ["i.png"], lambda c: X.stem_with_images(F.lit("stem"), c), "array<string>") == "stem<i.png>"
    assert one(spark, None, lambda c: X.stem_with_images(F.lit("stem"), c), "array<string>") == "stem"


def test_similarities(spark):
    a, b = [1.0, 2.0, 4.0], [2.0, 0.5, 3.0]
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    got = df.select(V.sim_euclid(F.col("a"), F.col("b")), V.sim_cosine(F.col("a"), F.col("b")), V.sim_pearson(F.col("a"), F.col("b"))).first()
    x, y = np.array(a), np.array(b)
    assert got[0] == pytest.approx(1 / (1 + np.linalg.norm(x - y)))
    assert got[1] == pytest.approx(0.5 + 0.5 * x @ y / np.linalg.norm(x) / np.linalg.norm(y))
    assert got[2] == pytest.approx(0.5 + 0.5 * np.corrcoef(x, y)[0, 1])
    short = spark.createDataFrame([([1.0, 2.0], [2.0, 1.0])], "a array<double>, b array<double>")
    assert short.select(V.sim_pearson(F.col("a"), F.col("b"))).first()[0] == 1.0
    assert not math.isnan(got[1])


def test_pages_of_a_batch_become_strings_in_slices():
    pages = pa.array([None if i % 7 == 0 else f"<p>page {i}</p><script>v{i}</script>" for i in range(300)])

    class Batch:
        taken = []

        def __len__(self):
            return len(pages)

        def slice(self, at, n):
            self.taken.append(n)
            return pages.slice(at, n)

    want = [X._text_nodes(p, True) for p in pages.to_pylist()]
    assert X._nodes_of(Batch(), True).to_pylist() == want
    assert max(Batch.taken) < 100
    assert X._nodes_of(pages.slice(0, 0), True).to_pylist() == []


def test_a_filter_on_text_nodes_parses_pages_once(spark):
    pages = spark.createDataFrame([(1, "<p>a</p>"), (2, "<i></i>")], "id int, html string")
    nodes = pages.withColumn("t", F.array_join(X.html_texts(F.col("html")), "")).filter("t <> ''")
    assert nodes.collect() == [(1, "<p>a</p>", "a")]
    assert nodes._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
