"""Prefix tables against the tiktoken library: any text, appends, edits, odd rows, and the whole query."""

import base64
import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riffle.llm import prefix_bpe as B

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")
RANKS, PATTERN = B.rank_file()
OWN = B.encoder(RANKS, PATTERN)
TABLE = {base64.b64decode(a): int(b) for a, b in map(str.split, RANKS.splitlines())}
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=TABLE, special_tokens={})
#: one word whatever it holds, so that it is encoded as one byte string
WORD = tiktoken.Encoding("word", pat_str=r"(?s).+", mergeable_ranks=TABLE, special_tokens={})
CASES = ["", " ", "  ", "a   b \n c\n\n  ", "<|endoftext|>x", "it's we'll 12 345ab", "é́ß中文 🙂", "  \xa0x  y 　", "x" * 3000, "ab " * 2000, " \n x\n y", "a\x1c b \x85c"]
TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabtheing<|>1é　\xa0 "), st.characters(exclude_categories=["Cs"])), max_size=40)


def ids(texts):
    return [memoryview(b).cast("i").tolist() for b in OWN.encode(pa.array(texts, type=pa.string()))]


def test_cases():
    assert ids(CASES) == [LIBRARY.encode_ordinary(t) for t in CASES]
    assert ids([None, "a", None]) == [[], LIBRARY.encode_ordinary("a"), []]
    assert ids([]) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_any_texts_together(texts):
    assert ids(texts) == [LIBRARY.encode_ordinary(t) for t in texts]
    assert [OWN.decode(i).decode() for i in ids(texts)] == texts


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeinrst ", max_size=30), st.text(alphabet="abeinrst ", max_size=30))
def test_appends_and_cuts(a, b):
    p = B.Prefixes(OWN.ranks, a.encode())
    p.append(b.encode())
    assert p.last == B.Prefixes(OWN.ranks, (a + b).encode()).last
    if (a + b).encode() not in TABLE:
        assert p.ids() == WORD.encode_ordinary(a + b)
    p.cut(len(a))
    assert p.last == B.Prefixes(OWN.ranks, a.encode()).last


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abeinrst ", max_size=120), st.integers(0, 120), st.integers(0, 9), st.text(alphabet="abeinrst ", max_size=9))
def test_edits(text, start, n, new):
    data = text.encode()
    start, end = min(start, len(data)), min(start + n, len(data))
    p = B.Prefixes(OWN.ranks, data)
    p.replace(start, end, new.encode())
    whole = data[:start] + new.encode() + data[end:]
    assert p.data == whole and p.last == B.Prefixes(OWN.ranks, whole).last


def test_edit_of_a_long_word_stays_near():
    data = b"international" * 400
    p = B.Prefixes(OWN.ranks, data)
    assert p.replace(2000, 2003, b"qqqq") < 200
    whole = data[:2000] + b"qqqq" + data[2003:]
    assert p.ids() == WORD.encode_ordinary(whole.decode())


def test_fits_by_definition():
    rng = random.Random(5)
    for a, b in zip(rng.choices(list(TABLE.values()), k=4000), rng.choices(list(TABLE.values()), k=4000)):
        pair = OWN.ranks.bytes_of[a] + OWN.ranks.bytes_of[b]
        assert OWN.ranks.fits(a, b) == (OWN.ranks.merge(pair) == [a, b])


@settings(max_examples=60, deadline=None)
@given(st.randoms(use_true_random=False), st.text(alphabet="abc", min_size=1, max_size=25))
def test_any_order_of_ranks(rng, text):
    """Also files whose tokens rank below their parts, or that merges never reach."""
    tokens = sorted({"".join(rng.choices("abc", k=rng.randint(2, 5))) for _ in range(25)})
    rng.shuffle(tokens)
    lines = [bytes([b]) for b in range(256)] + [t.encode() for t in tokens]
    own = B.Ranks("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(lines)))
    assert B.Prefixes(own, text.encode()).ids() == own.merge(text.encode())


def test_words_of_the_file_that_merges_do_not_reach():
    """A word that is in the file is that token, whatever its merges give."""
    odd = [t for t in list(TABLE)[::50] if OWN.ranks.merge(t) != [TABLE[t]]]
    for t in odd + list(TABLE)[300::997]:
        assert OWN.words([t])[t] == TABLE[t].to_bytes(4, "little")


def test_table_with_nulls_clashes_and_repeats(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "the  end\n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = B.decode(B.encode(df, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert out[0].__fields__ == ["doc_id", "text", "ids", "decoded"]
    assert [(r.doc_id, list(r.ids), bytes(r.decoded)) for r in out] == [
        (1, [], b""), (1, [], b""), (2, [], b""), (None, LIBRARY.encode_ordinary("the  end\n"), b"the  end\n")
    ]
    assert B.encode(df.limit(0), RANKS, PATTERN).count() == 0 and B.digests(df.limit(0), RANKS, PATTERN).count() == 0
    assert B.decode(spark.createDataFrame([(None,)], "ids array<int>"), RANKS, PATTERN).first().decoded is None


def test_rank_file_without_all_bytes():
    with pytest.raises(ValueError, match="256"):
        B.Ranks(base64.b64encode(b"a").decode() + " 0")


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = B.prefix_bpe_tokens(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = LIBRARY.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in want)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
