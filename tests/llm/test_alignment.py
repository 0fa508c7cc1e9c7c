"""Merge path against plain merging, stretches against whole texts, and the query against a brute-force version."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riffle.llm import alignment as M

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
pytest.importorskip("public_tokenizers")
FILES = M.vocabulary_files()
PAIR = M.Pair(*FILES)
LIBRARY = tokenizers.Tokenizer.from_str(FILES[0])
LIBRARY.encode_special_tokens = True
CASES = ["", " ", "  a", "a   b \n c\n\n  ", "<|endoftext|>x <s> </s> <unk>", "x▁y and z", "é́ß中文 🙂 中文", "  \xa0x  y 　", "ab " * 900, "x" * 3000, " \n x\n y ", "a\x1c b \x85c \x00"]
TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabtheing<|>1é　\xa0▁"), st.characters(exclude_categories=["Cs"])), max_size=30)


def plain(text):
    """Ids, groups and links of a text by whole-text encoding and all pairs of byte ranges."""
    if not text:
        return [], [], [], []
    want = (" " + text).encode()
    a = LIBRARY.encode(" " + text, add_special_tokens=False).ids
    b = PAIR.b.encode(text)
    if b"".join(PAIR.a_bytes[i] for i in a) != want or b"".join(PAIR.b_bytes[i] for i in b) != want:
        return [], [], [], []
    spans = []
    for ids, own in ((a, PAIR.a_bytes), (b, PAIR.b_bytes)):
        ends = np.cumsum([len(own[i]) for i in ids]).tolist()
        spans.append(list(zip([0, *ends], ends)))
    links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    group = [([a[i] for i, (s, e) in enumerate(spans[0]) if x < e <= y], [b[j] for j, (s, e) in enumerate(spans[1]) if x < e <= y]) for x, y in zip([0, *cuts], cuts)]
    return a, b, group, links


def as_text(group):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in group)


def brute(rows):
    done = [(i, *plain(t)) for i, t in rows]
    count = Counter((a[i], b[j]) for _, a, b, _, links in done for i, j in links)
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, a, b, group, links in done:
        n = [count[a[x], b[y]] for x, y in links]
        best = sum(k == most[b[y]] for k, (_, y) in zip(n, links))
        out.append((i, len(a), len(b), len(group), len(links), best, sum(n), hashlib.sha256(as_text(group).encode()).hexdigest() if a else ""))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.lists(st.integers(1, 9), max_size=30), st.integers(1, 9))
def test_merge_path_in_pieces(a_lengths, b_lengths, work):
    a = np.cumsum(a_lengths)
    b = np.array(sorted({*np.cumsum(b_lengths or [1])[np.cumsum(b_lengths or [1]) < a[-1]].tolist(), int(a[-1])}))
    i, j, a_closes, b_closes = M.merge_path(a, b, work)
    starts = [np.append(0, x[:-1]) for x in (a, b)]
    assert list(zip(i.tolist(), j.tolist())) == [(x, y) for x in range(len(a)) for y in range(len(b)) if starts[0][x] < b[y] and starts[1][y] < a[x]]
    both = sorted(set(a.tolist()) & set(b.tolist()))
    assert a_closes.tolist() == [a.tolist().index(e) + 1 for e in both] and b_closes.tolist() == [b.tolist().index(e) + 1 for e in both]


def test_pieces_are_equal_work():
    a, b = np.arange(1, 100_001), np.array([100_000])
    at = M.splits(a, b, np.arange(0, 100_001, 1000))
    assert (np.diff(at) == 1000).all()


def groups_of(texts):
    c = M.Chunk(PAIR)
    c.add(pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string()))
    return [c.groups(d).decode() for d in c.documents()]


def test_cases():
    assert groups_of([*CASES, None]) == [*(as_text(plain(t)[2]) for t in CASES), ""]
    assert plain("x▁y and z")[0] == []


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_any_texts_together(texts):
    assert groups_of(texts) == [as_text(plain(t)[2]) for t in texts]


def test_table_with_nulls_repeats_and_clashes(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(CASES[:8])] + [(3, "ab ab the", "x", None), (None, "ab ab the", None, "y"), (5, None, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, groups string, chunk string")
    want = sorted(brute([r[:2] for r in rows]), key=repr)
    for size in (1, 10_000):
        got = M.align(df.repartition(3), *FILES, chunk_stretches=size)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert M.align(df.limit(0), *FILES).count() == 0
    out = M.groups(df, *FILES)
    assert out.columns == ["doc_id", "text", "chunk", "groups"] and [r.groups for r in out.collect()] == [as_text(plain(r[1])[2]) for r in rows]
    n = {(r.a, r.b): r.n for r in M.pair_counts(df, *FILES).collect()}
    done = [plain(r[1]) for r in rows]
    assert n == Counter((a[i], b[j]) for a, b, _, links in done for i, j in links)


def test_a_file_holds_few_chunks(spark):
    rows = [(i, f"some words {i}") for i in range(30)]
    state = M.chunks(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), *FILES, chunk_stretches=1)
    sizes = [r["count"] for r in state.groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) >= 1 and max(sizes) <= M.CHUNKS_PER_FILE


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    df = spark.createDataFrame(short, "doc_id long, text string")
    assert sorted(map(tuple, M.align(df, *FILES).collect())) == sorted(brute(short))
    assert sorted(r.doc_id for r in M.token_alignment(spark, sf).collect()) == sorted(r[0] for r in rows)
