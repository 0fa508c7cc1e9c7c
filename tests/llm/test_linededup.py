"""Boilerplate against a plain count and SQL; sketches and exact counts on both sides of the threshold."""

from collections import defaultdict

import pytest
from oracle import connect, plain, rows_of

from riffle.llm import linededup as ld


def brute(rows, min_sites, max_share):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n") if text is not None else []:
            if line.strip(" \t\r") and site is not None:
                sites[line].add(site)
    out = []
    for d, text, _ in rows:
        if text is None:
            out.append((d, None, 0, 0, 0))
            continue
        lines = text.split("\n")
        left = [x for x in lines if len(sites.get(x, ())) < min_sites]
        clean, cross = "\n".join(left), len(lines) - len(left)
        go = cross and len(text) - len(clean) <= max_share * len(text)
        out.append((d, clean if go else text, len(lines), cross, cross if go else 0))
    return sorted(out, key=repr)


@pytest.mark.parametrize("min_sites", [2, 3, 60])
def test_against_plain_counts(spark, min_sites):
    rows = [(i, f"own text of {i} which is rather long\nshared by all\n\n \t\nshared by {i % 50}\nend", f"s{i}") for i in range(120)]
    rows += [(200, None, "s1"), (201, "", "s2"), (202, "shared by all", "s3"), (203, "a\r\na\r\nshared by all", None), (203, "a\r\na\r\nshared by all", None)]
    rows += [(300, "shared by all\n" + "word " * 40000, "s9"), (None, "shared by all\nsomething of its own", "s8")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, n_lines string, line int").repartition(4)
    out = ld.strip_lines(df, ld.boilerplate(df, min_sites))
    assert set(out.columns) == {"doc_id", "text", "source", "line", "n_lines", "n_cross_site", "n_removed"}
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_cross_site, r.n_removed) for r in out.collect()), key=repr)
    assert got == brute(rows, min_sites, 0.5)
    assert ld.strip_lines(df.limit(0), ld.boilerplate(df.limit(0))).count() == 0


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    df = ld.op1(spark, sf)
    res = connect(sf).execute(ld.SQL)
    names = [c[0] for c in res.description]
    got = rows_of(df.columns, df.collect())
    assert got == rows_of(names, res.fetchall()) and any(plain(r[1]) for r in got)
