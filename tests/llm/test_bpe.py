"""The encoder against a public implementation and by round trips."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from folioloom.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module", params=["byte_bpe_50k", "byte_bpe_multi_50k"])
def pair(request):
    v = bpe.load(request.param)
    ranks = {v.blob[a:b]: i for i, (a, b) in enumerate(zip(v.offsets, v.offsets[1:], strict=False))}
    return bpe.Encoder(v), tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="abeth gin '\n1é中😀", max_size=200)))
def test_random_texts(pair, text):
    own, other = pair
    assert own.encode(text) == other.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text


def test_long_piece_is_linear(pair):
    own, other = pair
    text = "abab" * 20_000 + "中" * 5_000
    assert own.encode(text) == other.encode_ordinary(text)


def test_tables_reject_a_token_without_merges():
    with pytest.raises(ValueError):
        bpe.tables({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


def test_frames(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "  x  ", 5), (3, "  x  ", 5), (4, "a<|endoftext|>" * 900, 5)], "doc_id long, text string, ids int")
    out = bpe.encode(df)
    rows = sorted((r.doc_id, r.ids) for r in out.collect())
    assert rows[0] == (1, []) and rows[1] == (2, []) and rows[2] == rows[3] and 50256 not in rows[4][1]
    back = {r.doc_id: r.text for r in bpe.decode(out).collect()}
    assert back == {1: "", 2: "", 3: "  x  ", 4: "a<|endoftext|>" * 900}
    counts = {r.doc_id: r.n_tokens for r in bpe.count_tokens(df, ["doc_id", "ids"]).collect()}
    assert counts[1] == 0 and counts[4] == len(rows[4][1])
    assert bpe.encode(df.limit(0)).count() == 0
