"""URL verdicts: longest rule, else naive Bayes over words that Viterbi segmentation finds in host names.

The word counts come from the pages' own text, all of it.  They are joined to the substrings of
distinct host names, so a task only ever holds the words inside one name.  Naive Bayes learns from all
urls that a rule decides; its table has one row for each token and is joined, not collected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import lower_az, materialize, table
from riffle.llm.registry import query

#: (verdict, host, start of path): fixed by the contract.
RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"),
]
#: Longest word that segmentation looks for.
LONGEST = 24


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_az(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Between the host and ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(verdict, rule) of the longest rule whose host is the host or above it and whose path starts the path; else null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # a longer one overrules
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(found)
    return found


def names(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    """(word, n) over all whole texts; markup between < and > does not count."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "<[^>]*>", " ")
    return texts.select(F.explode(names(plain)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def best_split(name: str, words: dict[str, float], unknown: float) -> list[str]:
    """Words of the most probable split; ``words`` are log-probabilities, a word that is none of them costs ``unknown`` and ln 10 a letter.

    Equal splits: the one with the longer last word.
    """
    best = [0.0]
    start = [0]
    for end in range(1, len(name) + 1):
        options = []
        for at in range(max(0, end - LONGEST), end):
            part = name[at:end]
            options.append((best[at] + words.get(part, unknown - math.log(10) * len(part)), -at))
        score, at = max(options)
        best.append(score)
        start.append(-at)
    out, end = [], len(name)
    while end:
        out.append(name[start[end] : end])
        end = start[end]
    return out[::-1]


def segment(found: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of every distinct name in column ``name``, split by unigram probabilities."""
    whole = materialize(counts)
    total = whole.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n or 1
    distinct = found.select("name").where("name <> ''").distinct()
    longest = F.least(F.length("name"), F.lit(LONGEST))
    parts = distinct.select("name", F.explode(F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(1), F.length("name")), lambda i: F.transform(F.sequence(F.lit(1), F.least(longest, F.length("name") - i + 1)), lambda n: F.substring(F.col("name"), i, n))
    )))).alias("word"))
    # the words inside one name: at most LONGEST for each of its letters
    held = parts.join(whole, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("held"))
    unknown = math.log(10 / total)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            known = [{h["word"]: math.log(h["n"] / total) for h in (x if x is not None else ())} for x in f.held]
            yield pd.DataFrame({"name": f.name, "words": [best_split(n, k, unknown) for n, k in zip(f["name"], known)]})

    return distinct.join(held, "name", "left").mapInPandas(run, "name string, words array<string>")


def _tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, path, token) of distinct urls: words of the segmented host, names in the path, # for numbers."""
    hosts = urls.select("host").distinct()
    pieces = hosts.select("host", F.explode(names(F.col("host"))).alias("name"))
    split = segment(pieces, counts)
    of_host = pieces.join(split, "name").select("host", F.explode("words").alias("word")).select("host", F.concat(F.lit("host "), "word").alias("token"))
    numbers = F.transform(F.regexp_extract_all("path", F.lit(r"[0-9]+"), F.lit(0)), lambda _: F.lit("#"))
    of_path = urls.select("host", "path", F.explode(F.concat(names(F.col("path")), numbers)).alias("word"))
    return urls.join(of_host, "host").select("host", "path", "token").unionByName(of_path.select("host", "path", F.concat(F.lit("path "), "word").alias("token")))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] | None = None, text: str = "html", url: str = "url") -> DataFrame:
    """``pages`` (page id and all) with host, path, rule, verdict and block_score; columns of these names are replaced.

    block_score is the log-odds for blocking by naive Bayes (add-one, tokens and priors from the urls that
    rules decide); the verdict without a rule is block above 0, else allow.  Null urls have an empty host and path and
    go by the prior; repeated urls count as often as they stand.
    """
    rules = RULES if rules is None else rules
    pages = pages.drop("host", "path", "rule", "verdict", "block_score")
    ruled = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))}).withColumn("_hit", match_rule(F.col("host"), F.col("path"), rules))
    urls = materialize(ruled.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.first("_hit").alias("hit")))
    tokens = materialize(_tokens(urls.select("host", "path"), word_counts(pages, text)))
    blocks, allows = (F.sum(F.when(F.col("hit.verdict") == v, F.col("n")).otherwise(0)) for v in ("block", "allow"))
    seen = tokens.join(urls, ["host", "path"]).groupBy("token").agg(blocks.alias("b"), allows.alias("a"))
    seen = materialize(seen)
    all_ = seen.agg(F.sum("b").alias("b"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("v")).first()
    prior = urls.agg(blocks.alias("b"), allows.alias("a")).first()
    weight = F.log((F.col("b") + 1) / ((all_.b or 0) + all_.v + 1)) - F.log((F.col("a") + 1) / ((all_.a or 0) + all_.v + 1))
    start = math.log(((prior.b or 0) + 1) / ((prior.a or 0) + 1))
    scored = tokens.join(seen.select("token", weight.alias("weight")), "token").groupBy("host", "path").agg(F.sum("weight").alias("weight"))
    score = F.lit(start) + F.coalesce("weight", F.lit(0.0))
    kept = ruled.join(scored, ["host", "path"], "left")
    return kept.select(
        *pages.columns, "host", "path", F.col("_hit.rule").alias("rule"),
        F.coalesce(F.col("_hit.verdict"), F.when(score > 0, "block").otherwise("allow")).alias("verdict"), score.alias("block_score"),
    )


@query("op7_url_verdicts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_score")
