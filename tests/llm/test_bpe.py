"""Encoding against the tokenizers library, and the exact round trip."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riffle.llm import bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
NAME = "byte_bpe_50k.json"
LIBRARY = tokenizers.Tokenizer.from_file(public_tokenizers.path(NAME))
TEXT = bpe.vocabulary_text(NAME)
CASES = ["", " ", "  ", "a   b \n c\n\n  ", "<|endoftext|>x <|endoftext|>", "it's we'll 12 345ab", "é́ß中文 🙂", "  \xa0x", "x" * 5000, "ab " * 3000]


def own(text):
    return np.frombuffer(bpe.codec(TEXT).encode(text), np.int32).tolist()


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert own(text) == want
    assert bpe.codec(TEXT).decode(want) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sabtheing<|>1é　"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_any_text(text):
    assert own(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=20))
def test_any_ids(ids):
    assert bpe.codec(TEXT).decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_table_with_nulls_clashes_and_repeats(spark):
    rows = [(1, None, "x"), (1, None, "x"), (2, "", "y"), (None, "the  end\n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, TEXT), TEXT, out="back").collect()
    assert sorted(out[0].asDict()) == ["back", "doc_id", "ids", "text"]
    assert [(r.doc_id, list(r.ids), r.back) for r in out] == [(1, [], ""), (1, [], ""), (2, [], ""), (None, own("the  end\n"), "the  end\n")]
    assert bpe.encode(df.limit(0), TEXT).count() == 0
    assert bpe.decode(spark.createDataFrame([(None,)], "ids array<int>"), TEXT).first().decoded is None


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in bpe.bpe_tokens(spark, sf).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
